"""Text normalisation as column expressions: one whitespace rule, one accent fold, one tokeniser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as white space (U+200B does not).
WHITESPACE = r"[\x{0009}-\x{000d}\x{001c}-\x{0020}\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"
#: Letters with accents and what they fold to; ß and ligatures stay.
ACCENTED = "áàâäãåéèêëíìîïóòôöõőúùûüűçñýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕŐÚÙÛÜŰÇÑÝ"
PLAIN = "aaaaaaeeeeiiiioooooouuuuucnyyAAAAAAEEEEIIIIOOOOOOUUUUUCNY"
TOKEN = r"[\p{L}\p{N}]+"
COMPOUND = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)+"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def collapse(x: Column | str) -> Column:
    """Runs of white space become one blank, ends are trimmed; null becomes empty. No Unicode normalisation."""
    return F.trim(F.regexp_replace(F.coalesce(_c(x), F.lit("")), WHITESPACE, " "))


def fold(x: Column | str) -> Column:
    """Lower case without accents."""
    return F.lower(F.translate(_c(x), ACCENTED, PLAIN))


def has_accent(x: Column | str) -> Column:
    return F.lower(_c(x)) != fold(x)


def tokens(x: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(_c(x)), F.lit(f"({TOKEN})"), F.lit(1))


def compounds(x: Column | str) -> Column:
    """Hyphenated words as wholes; their parts are among `tokens`. An en dash joins nothing."""
    return F.regexp_extract_all(F.lower(_c(x)), F.lit(f"({COMPOUND})"), F.lit(1))


def same_text(a: Column | str, b: Column | str) -> Column:
    return F.lower(collapse(a)) == F.lower(collapse(b))


def array_to_string(x: Column | str) -> Column:
    return F.array_join(_c(x), " ")


# The named entities that plain markup uses.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def html_text(x: Column | str) -> Column:
    """Text of simple markup: comments go, <br> is a newline, tags go without a blank, entities are read, white space collapses."""
    t = F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"(?s)<!--.*?-->", "")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>", "\n")
    t = F.regexp_replace(t, r"<[^>]*>", "")
    for name, char in ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    return collapse(t)


# Phrases, folded, whose presence marks a line as furniture, and regional domains of footer lists.
BOILERPLATE_PHRASES = (
    "az on adatainak vedelme fontos", "sutiket es mas technologiakat", "partnerunkkel", "hozzajarulasat barmikor modosithatja",
    "suti beallitasok", "adatvedelmi tajekoztato", "felhasznalasi feltetelek", "tovabbi lehetosegek", "elfogadom", "cookie",
    "kiskoruakra karosak lehetnek", "szuroprogram", "elmultam 18 eves", "nem multam el 18 eves", "ha on elmult 18 eves",
    "minden jog fenntartva", "portfolionk minosegi tartalmat", "regionalis hirportalok", "impresszum", "szerzoink", "nevnapja",
    "top hirek", "hirlevel-feliratkozas", "nem akar lemaradni a", "adja meg a nevet es az e-mail", "feliratkozom a hirlevelre",
    "iratkozzon fel hirlevelunkre",
)
REGIONAL = r"(?i)\b(baon|bama|beol|boon|delmagyar|duol|feol|kisalfold|haon|heol|szoljon|kemma|nool|sonline|szon|teol|vaol|veol|zaol)\.hu\b"


def is_boilerplate(x: Column | str, phrases: tuple[str, ...] = BOILERPLATE_PHRASES) -> Column:
    """A furniture line: a known phrase, a short line with a regional domain, or one or two words in capitals."""
    return _let(collapse(x), lambda line: _let(fold(line), lambda folded: _furniture(line, folded, phrases)))


def _let(x: Column, f) -> Column:
    """f(x) with x evaluated once; a filter else evaluates it at each place it stands."""
    return F.exists(F.array(x), f)


def _furniture(line: Column, folded: Column, phrases: tuple[str, ...]) -> Column:
    phrase = F.lit(False)
    for p in phrases:
        phrase = phrase | folded.contains(p)
    label = (F.size(F.split(line, " ")) <= 2) & (F.upper(line) == line) & (F.lower(line) != line) & (F.length(line) < 20)
    return (line != "") & (phrase | (line.rlike(REGIONAL) & (F.length(line) < 60)) | label)
