"""Elements of XML documents at any depth, with the elements around them.

A schema can only name elements at a fixed depth. Here a document is cut into
tags by a pattern, and the tags are numbered (operators/nesting.py), which says where
the elements of interest stand. Attributes and texts are read by the XML
parser, from small fragments, all those of a document at once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapledger.operators.nesting import STEPS
from mapledger.schemas import XML_OPTIONS

_ATTRIBUTES = """[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+"""
_NAME = "[^\\s/>!?<]++"
_TAG = f"</?{_NAME}{_ATTRIBUTES}>"
_ASIDE = "<!--.*?-->|<\\?.*?\\?>"
_CDATA = "<!\\[CDATA\\[.*?\\]\\]>"
# both, by one first character that most places of a text rule out
_HIDDEN = "(?s)<(?:!\\[CDATA\\[.*?\\]\\]>|!--.*?-->|\\?.*?\\?>)"
# a tag, or what may stand before the first one, with the text behind it
_TOKEN = f"(?s)(?:{_TAG}|{_ASIDE}|<![^>\\[]*(?:\\[.*?\\])?\\s*>)[^<]*+(?:(?:{_CDATA}|{_ASIDE})[^<]*+)*+"
_EMPTY_TAG = f"(?s)^<{_NAME}{_ATTRIBUTES}(?<=/)>"

# an ampersand outside of CDATA that is none of the references every parser knows
_OWN_ENTITY = "(?s)&(?!(?:amp|lt|gt|quot|apos);|#)(?!(?:(?!<!\\[CDATA\\[).)*?\\]\\]>)"

# references to white space, as patterns
_SPACES = {
    "&#(?:0*9|[xX]0*9);": "\t",
    "&#(?:0*10|[xX]0*[aA]);": "\n",
    "&#(?:0*13|[xX]0*[dD]);": "\r",
    "&#(?:0*32|[xX]0*20);": " ",
}

def tokens(content: Column | str) -> Column:
    """Tags of a document, each with the text behind it."""
    return F.regexp_extract_all(content, F.lit(_TOKEN), F.lit(0))


def marks(tokens: str, roles: list[str]) -> Column:
    """Each tag as one number: what its name's place among the roles is, and whether it opens, closes or is empty; else null."""

    def mark(token: Column) -> Column:
        is_empty = F.contains(token, F.lit("/>")) & F.rlike(token, F.lit(_EMPTY_TAG))
        step = F.when(F.startswith(token, F.lit("</")), 0).when(is_empty, 1).otherwise(2)
        aside = F.startswith(token, F.lit("<!")) | F.startswith(token, F.lit("<?"))
        role = F.array_position(F.array(*[F.lit(name) for name in roles]), F.regexp_extract(token, f"^</?({_NAME})", 1))
        return F.when(~aside, (role * STEPS + step).cast("int"))

    return F.transform(tokens, mark)


def count_tags(content: Column | str, name: str) -> Column:
    """How many elements of that name a document's text opens, comments and CDATA aside; independent of any extraction."""
    content = F.col(content) if isinstance(content, str) else content
    aside = F.contains(content, F.lit("<!")) | F.contains(content, F.lit("<?"))
    plain = F.when(aside, F.regexp_replace(content, _HIDDEN, "")).otherwise(content)
    return F.regexp_count(plain, F.lit(f"<{name}(?=[\\s/>])")).cast("bigint")


def _tag(token: Column) -> Column:
    return F.regexp_extract(token, f"(?s)^{_TAG}", 0)


def alone(token: Column, name: str) -> Column:
    """The element of a token without its content, under another name."""
    renamed = F.regexp_replace(_tag(token), f"^<{_NAME}", f"<{name}")
    return F.regexp_replace(renamed, "/?>$", "/>")


def with_text(token: Column, name: str) -> Column:
    """The element of a token and the text before its first child, under another name."""
    tag = _tag(token)
    # comments don't part a text
    text = F.regexp_replace(F.substr(token, F.length(tag) + 1), f"(?s)({_CDATA})|{_ASIDE}", "$1")
    opened = F.regexp_replace(F.regexp_replace(tag, f"^<{_NAME}", f"<{name}"), "/?>$", ">")
    empty = F.rlike(token, F.lit(_EMPTY_TAG))
    return F.when(empty, alone(token, name)).otherwise(F.concat(opened, text, F.lit(f"</{name}>")))


def fragment(*elements: Column) -> Column:
    """Some elements as one piece; a reference to an entity that the document declares itself stays as it is written."""
    return F.concat(F.lit("<p>"), F.regexp_replace(F.concat(*elements), _OWN_ENTITY, "&amp;"), F.lit("</p>"))


def read(fragments: Column, schema: str) -> Column:
    """Attributes and texts of each fragment as a struct; one parser reads all fragments of a document."""
    whole = F.concat(F.lit("<r>"), F.array_join(fragments, ""), F.lit("</r>"))
    return F.coalesce(F.from_xml(whole, f"p ARRAY<STRUCT<{schema}>>", XML_OPTIONS)["p"], F.array().cast(f"ARRAY<STRUCT<{schema}>>"))


def blank_text(token: Column) -> Column:
    """The text of an element if it is white space only, which the parser leaves out; otherwise null."""
    text = F.substr(token, F.length(_tag(token)) + 1)
    text = F.regexp_replace(text, f"(?s){_ASIDE}|<!\\[CDATA\\[(?=\\s*\\]\\]>)|(?<=[\\s\\[])\\]\\]>", "")
    blank = F.regexp_replace(F.regexp_extract(text, f"^(?:\\s|{'|'.join(_SPACES)})+$", 0), "\r\n?", "\n")
    for reference, character in _SPACES.items():
        blank = F.regexp_replace(blank, reference, character)
    return F.when((F.length(blank) > 0) & ~F.rlike(token, F.lit(_EMPTY_TAG)), blank)
