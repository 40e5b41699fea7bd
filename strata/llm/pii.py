"""Personal data with DataFrame functions only (operator 2).

Regular expressions propose spans, checksums and number rules confirm them (Luhn
for cards, mod-97 for IBANs, digit counts, part ranges), and words near a span
raise or lower its score.  Everything is an expression over one row: no shuffle,
no Python, and a hot source or a very long text is only a longer row.

Positions: for a pattern, ``split`` gives the gaps and ``regexp_extract_all``
the matches in between, so the starts are running sums of lengths.  The running
sums work in blocks of 256, which keeps them near linear for texts with very
many matches.  The patterns use possessive quantifiers and begin only where a
match can begin (``\\G`` is the end of the match before), so no text makes them
backtrack over long runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_prefix

NEAR, KEEP, BLOCK = 48, 0.5, 256

#: Total IBAN length by country, the whole registry.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30}


def _iban_pattern() -> str:
    """One alternative for each length."""
    of = {n: [c for c, m in IBAN_LENGTH.items() if m == n] for n in sorted(set(IBAN_LENGTH.values()))}
    return "(?:" + "|".join(f"(?:{'|'.join(c)})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, c in of.items()) + ")"


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes; ``base`` kinds stay whatever their score; ``words``
    nearby add 0.3 to ``prior``, ``against`` take 0.3 off."""
    name: str
    pattern: str
    needs: str
    prior: float
    words: str
    base: bool = True
    against: str = r"\b(?:version|invoice|order no|isbn|serial)\b"


KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         r"\b(?:e-?mail|contact|write|courriel|correo)\b"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6,
         r"\b(?:ip|host|server|address|adresse)\b"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9](?:[\\x20-]?[0-9]){11}", 0.6,
         r"\b(?:card|visa|mastercard|credit|karte|carte|tarjeta)\b"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6,
         r"\b(?:phone|tel|call|mobile|fax|telefon|teléfono)\b"),
    Kind("iban", _iban_pattern(), "[A-Z]{2}[0-9]{2}", 0.9, r"\b(?:iban|bank|account|konto|compte|cuenta)\b", base=False, against="$^"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]-[0-9]{2}-[0-9]", 0.3,
         r"\b(?:ssn|social security|social insurance)\b", base=False),
]


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes Luhn's test."""
    padded = F.lpad(digits, 19, "0")
    total = F.lit(0)
    for i in range(1, 20):
        d = F.substring(padded, i, 1).cast("int")
        total = total + (d if i % 2 else 2 * d - F.when(d > 4, 9).otherwise(0))
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces passes the mod-97 test."""
    turned = F.concat(F.substring(iban, 5, 40), F.substring(iban, 1, 4))
    return F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda acc, c: F.when(c == "", acc).when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97)
        .otherwise((acc * 100 + F.ascii(c) - 55) % 97)) == 1


_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"


def confirmed(kind: str, hit: Column, before: Column, after: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        digits = F.translate(hit, " -", "")
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(F.translate(hit, "+ ().-", "")).between(9, 15)
    if kind == "iban":
        return ~before.rlike("[A-Za-z0-9]$") & ~after.rlike("^[A-Za-z0-9]") & mod97(F.translate(hit, " ", ""))
    if kind == "ssn":
        return (~before.rlike("[0-9-]$") & ~after.rlike("^[0-9-]") & ~hit.rlike("^(?:000|666|9)")
                & ~hit.rlike("-00-|-0000$"))
    return F.lit(True)


def _running(blocks: Column, base: Column, step) -> Column:
    """Exclusive running totals of the numbers in ``blocks``; ``base`` holds the
    totals before each block."""
    return F.flatten(F.zip_with(blocks, base, lambda xs, b: F.slice(
        F.aggregate(xs, F.array(b), lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x)))),
        1, F.size(xs))))


def _blocks(numbers: Column) -> Column:
    last = F.greatest(F.lit(0), F.ceil(F.size(numbers) / BLOCK).cast("int") - 1)
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(numbers, b * BLOCK + 1, BLOCK))


def _bases(blocks: Column, zero: Column, step) -> Column:
    totals = F.transform(blocks, lambda xs: F.aggregate(xs, zero, step))
    return F.aggregate(totals, F.array(zero),
                       lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x))))


def _add(a: Column, b: Column) -> Column:
    return a + b



def _most(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _judged(nth: int, k: Kind):
    """From a match and the start of its gap to its span, or null."""
    def one(z: Column, at: Column) -> Column:
        near = F.lower(F.concat(z.before, F.lit(" "), z.after))
        score = (F.lit(k.prior) + F.when(near.rlike(k.words), 0.3).otherwise(0.0)
                 - F.when(near.rlike(k.against), 0.3).otherwise(0.0))
        score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))
        ok = confirmed(k.name, z.hit, z.before, z.after)
        return F.when(ok if k.base else ok & (score >= KEEP), F.struct(
            (at + z.gap).alias("start"), F.lit(nth).alias("nth"), (at + z.gap + z.size).alias("end"),
            F.lit(k.name).alias("kind"), score.alias("score"), F.lit(k.base).alias("base")))
    return one


def spans(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with a column ``out``: an array of (start, end, kind, score,
    base, nth) sorted by start and kind; offsets in code points, end exclusive.

    A null or empty text has no spans.  All columns of ``docs`` stay, whatever
    their names, but one named ``out``, which is replaced; repeated rows get equal results."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = free_prefix(docs, "_pii_")
    whole, names = f"{own}text", [f"{own}{i}" for i in range(len(KINDS))]
    df = docs.withColumn(whole, text)
    # gaps and matches; the patterns run only on texts that hold what they need
    df = df.withColumns({n: F.when(F.col(whole).rlike(k.needs), F.split(whole, k.pattern, -1))
                         for n, k in zip(names, KINDS, strict=True)})
    df = df.withColumns({n: F.when(F.size(n) > 1, F.zip_with(
        F.zip_with(F.slice(n, 1, F.size(n) - 1), F.slice(n, 2, F.size(n)),
                   lambda a, b: F.struct(F.length(a).alias("gap"), F.right(a, F.lit(NEAR)).alias("before"),
                                         F.left(b, F.lit(NEAR)).alias("after"))),
        F.regexp_extract_all(whole, F.lit(k.pattern), F.lit(0)),
        lambda g, hit: F.struct(g.gap.alias("gap"), F.length(hit).alias("size"), hit.alias("hit"),
                                g.before.alias("before"), g.after.alias("after"))))
        for n, k in zip(names, KINDS, strict=True)})
    zero = F.lit(0)
    df = df.withColumns({f"{n}_b": F.when(F.col(n).isNotNull(), _blocks(F.transform(n, lambda z: z.gap + z.size)))
                         for n in names})
    df = df.withColumns({f"{n}_s": F.when(F.col(n).isNotNull(),
                                          _running(F.col(f"{n}_b"), F.slice(_bases(F.col(f"{n}_b"), zero, _add), 1,
                                                                            F.size(f"{n}_b")), _add))
                         for n in names})
    made = [F.filter(F.coalesce(F.zip_with(n, f"{n}_s", _judged(nth, k)), F.array()), lambda s: s.isNotNull())
            for nth, (n, k) in enumerate(zip(names, KINDS, strict=True))]
    df = df.withColumn(out, F.array_sort(F.concat(*made)))
    return df.drop(whole, *names, *[f"{n}_b" for n in names], *[f"{n}_s" for n in names])


def _told(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def _count(pii: str, kind: str) -> Column:
    return F.size(F.filter(pii, lambda s: s.kind == kind)).cast("long")


def digest(found: DataFrame, id_col: str = "doc_id", pii: str = "pii") -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as text."""
    base = F.filter(pii, lambda s: s.base)
    return found.select(
        F.col(id_col).cast("long").alias("doc_id"),
        *[_count(pii, k.name).alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(_told(base), 256).alias("base_sha256"), _told(F.col(pii)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping
    spans by the first one's), and ``chars_col``, if there is one, brought up to
    date.  A null text stays null; other columns stay as they are."""
    own = free_prefix(docs, "_found")
    hits, ended, upto = own, f"{own}_e", f"{own}_p"
    df = spans(docs, text_col, hits)
    ends = F.transform(hits, lambda s: s.end)
    df = df.withColumn(ended, _blocks(ends))
    df = df.withColumn(upto, _running(F.col(ended), F.slice(_bases(F.col(ended), F.lit(0), _most), 1, F.size(ended)), _most))
    text = F.col(text_col).cast("string")
    pieces = F.zip_with(hits, upto, lambda s, p: F.when(
        s.start >= p, F.concat(text.substr(p + 1, s.start - p), F.lit("["), F.upper(s.kind), F.lit("]")))
        .otherwise(F.lit("")))
    rest = text.substr(F.array_max(ends) + 1, F.length(text))
    new = F.when(F.size(hits) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(text)
    df = df.withColumn(text_col, new)
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        df = df.withColumn(chars_col, F.when(F.size(hits) > 0, F.length(text_col)).otherwise(F.col(chars_col))
                           .cast(kind))
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])
