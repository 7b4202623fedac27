"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts the score.

Only DataFrame functions run here. All patterns use possessive quantifiers and a look-behind (or the
end of the match before), so a text costs time in proportion to its length, whatever it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base kinds in the order in which spans of equal start are listed, then the kinds that the method adds.
KINDS = ("email", "ip", "card", "phone", "iban", "nid", "tel")
BASE = KINDS[:4]

# Lengths of the International Bank Account Number by country (ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ CY DO GT HU LB PL", 29: "BR PS QA UA", 30: "JO KW MU", 31: "LC MT SC",
}
#: A number of a known country ends where its length says, whatever stands behind it; of others, the longest run of groups counts.
_IBAN = "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}+(?![A-Za-z0-9])" for n, names in IBAN_LENGTHS.items())

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?:{_IBAN}|[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}+(?:\x20?[A-Z0-9]{{1,3}})?+(?![A-Za-z0-9]))",
    "nid": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "tel": r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9A-Za-z-])",
}
#: A text without a match of this has no span of the kind: a cheap look before matches are cut out.
GUARDS = {
    "email": r"@[A-Za-z0-9-]++\.",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
    "nid": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "tel": r"[0-9]{3}\)?[.\x20-]?[0-9]{3}[.\x20-][0-9]{4}",
}
#: Score of a confirmed span by itself, what a context word within CONTEXT characters before it adds, and what is kept of added kinds.
SCORES = {"email": 0.9, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.8, "nid": 0.2, "tel": 0.3}
LIFT, LEAST, CONTEXT = 0.4, 0.5, 40
WORDS = {
    "email": r"\b(?:e-?mail|mail|contact|write)\b",
    "ip": r"\b(?:ip|host|server|address)\b",
    "card": r"\b(?:card|visa|mastercard|credit|debit|payment)\b",
    "phone": r"\b(?:call|phone|tel|telephone|mobile|fax|cell)\b",
    "iban": r"\b(?:iban|account|bank|konto|compte|cuenta)\b",
    "nid": r"\b(?:ssn|social security|national id|passport)\b",
    "tel": r"\b(?:call|phone|tel|telephone|mobile|fax|cell)\b",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Running sums over matches go in blocks of so many, so that thousands of matches in a text stay cheap.
_BLOCK = 128


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True for 14 to 19 digits whose Luhn sum is a multiple of ten."""
    padded = F.lpad(digits, 20, "0")  # leading zeros do not change the sum
    doubled = F.translate(padded, "0123456789", "0246813579")  # twice the digit, its digits added
    total = sum((F.substring(padded if i % 2 == 0 else doubled, i, 1).cast("int") for i in range(1, 21)), F.lit(0))
    return F.length(digits).between(14, 19) & (total % 10 == 0)


def mod97(iban: Column) -> Column:
    """True if the ISO 13616 checksum holds: moved front to back, letters as 10 to 35, remainder 1."""
    bare = F.replace(iban, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(bare, 5, 34), F.substring(bare, 1, 4))
    step = lambda acc, c: F.when(c <= "9", (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.length(bare).between(15, 34) & (F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1)


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(f"^{_OCTET}(?:\\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(m) >= 14, luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    if kind == "iban":
        return mod97(m)
    return F.lit(True)


def _starts(steps: Column) -> Column:
    """Inclusive running sums of an array, block by block."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(steps) / _BLOCK).cast("int")), lambda b: F.aggregate(F.slice(steps, b * _BLOCK + 1, _BLOCK), F.lit(0), lambda a, x: a + x))
    return F.transform(
        steps,
        lambda _, i: F.aggregate(F.slice(steps, (i - i % _BLOCK) + 1, i % _BLOCK + 1), F.lit(0), lambda a, x: a + x)
        + F.aggregate(F.slice(blocks, 1, F.floor(i / _BLOCK).cast("int")), F.lit(0), lambda a, x: a + x),
    )


def spans(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Add `found`: array of (start, kind_no, kind, end, score), sorted; positions in code points, end exclusive.

    Matches are leftmost and non-overlapping for each kind; kinds may overlap each other. Base kinds stay whatever
    their score; the added kinds (iban, nid, tel) stay from a score of LEAST. A null text counts as empty.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")
    cut = docs.select(*keep, *[
        F.when(whole.rlike(GUARDS[k]), F.struct(F.split(whole, PATTERNS[k], -1).alias("gaps"), F.regexp_extract_all(whole, F.lit(PATTERNS[k]), F.lit(0)).alias("hits")))
        .otherwise(F.struct(none.alias("gaps"), none.alias("hits"))).alias(f"__{k}")
        for k in KINDS
    ])

    def measured(hits: Column, gaps: Column) -> Column:
        # steps: what lies between the start of one match and of the next
        near = F.transform(gaps, lambda g: F.lower(F.right(g, F.lit(CONTEXT))))
        apart = F.transform(hits, lambda _, i: F.length(F.get(gaps, i)) + F.when(i > 0, F.length(F.get(hits, i - 1))).otherwise(0))
        return F.struct(hits.alias("hits"), near.alias("near"), apart.alias("steps"))

    steps = cut.select(*keep, *[measured(F.col(f"__{k}.hits"), F.col(f"__{k}.gaps")).alias(f"__{k}") for k in KINDS])
    placed = steps.select(*keep, *[F.struct(F.col(f"__{k}.hits").alias("hits"), F.col(f"__{k}.near").alias("near"), F.when(F.size(f"__{k}.hits") > 0, _starts(F.col(f"__{k}.steps"))).alias("starts")).alias(f"__{k}") for k in KINDS])

    def of(k: str) -> Column:
        rows = F.transform(
            F.col(f"__{k}.hits"),
            lambda m, i: F.struct(
                F.get(F.col(f"__{k}.starts"), i).alias("start"), F.lit(KINDS.index(k)).alias("kind_no"), F.lit(k).alias("kind"),
                (F.get(F.col(f"__{k}.starts"), i) + F.length(m)).alias("end"),
                F.when(_valid(k, m), SCORES[k] + F.when(F.get(F.col(f"__{k}.near"), i).rlike(WORDS[k]), LIFT).otherwise(0.0)).alias("score"),
            ),
        )
        least = 0.0 if k in BASE else LEAST
        return F.filter(rows, lambda x: x["score"].isNotNull() & (x["score"] >= least))

    return placed.select(*keep, F.array_sort(F.concat(*[of(k) for k in KINDS])).alias("found"))


def find_pii(docs: DataFrame) -> DataFrame:
    """Personal data of every whole text of (doc_id, text).

    Result: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores. base_sha256 is the SHA-256 of the base
    spans as kind:start:end joined by commas; spans lists base and added spans likewise, scores their scores.

    A null or empty text has no spans (the hash is that of no bytes). One row per input row, so repeated
    rows give repeated rows; an empty table gives an empty result; other columns of `docs` are ignored.
    """
    found = spans(docs.select("doc_id", "text"), keep=("doc_id",))
    show = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("found", lambda x: x["kind_no"] < len(BASE))
    number = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k))
    return found.select(
        "doc_id",
        *[number(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(F.transform(base, show), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", show), ",").alias("spans"),
        F.array_join(F.transform("found", lambda x: F.format_number(x["score"], 2)), ",").alias("scores"),
    )
