"""Personal data, with DataFrame operations only.

Regular expressions propose spans of each kind; validators (ranges, Luhn,
lengths, mod 97) confirm them; words near a span move its score. Spans of the
base kinds are always kept; those of further kinds are kept from a score on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Proposals. A pattern's first part takes all it can and cannot give back
# (++), and a match begins where such a part begins or the last match ended
# (\G), which finds the same spans without trying every place inside a run.
LOCAL = r"[A-Za-z0-9._%+-]"
#: Characters of an account number by country (ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
#: A country's letters decide how many characters follow, whatever stands after them.
IBAN = "|".join(rf"(?:{'|'.join(countries.split())})[0-9]{{2}}(?:[\x20]?[A-Z0-9]){{{length - 4}}}" for length, countries in IBAN_LENGTHS.items())
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN})(?![A-Za-z0-9])",
    "national": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Without one of these characters a text has no span of the kind.
SIGNS = {"email": "@", "phone": "+", "national": "-"}
BASE = ("email", "ip", "card", "phone")
#: A span's score before context, what context adds, and the score that further kinds need.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "national": 0.3}
NEAR, NEAR_CHARS, NEEDED = 0.3, 40, 0.5
CONTEXT = {
    "email": "mail|contact|reply", "ip": "ip|server|host|address", "card": "card|visa|credit|payment", "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|transfer", "national": "ssn|social|security|national|identity",
}


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes; from the right every second digit doubles."""
    each = F.transform(F.split(F.reverse(number), "(?!^)(?!$)"), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.floor(d.cast("int") * 2 / 10).cast("int") + d.cast("int") * 2 % 10))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether letters and digits pass, the first four moved to the end and letters read as 10 to 35."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substring(account, 1, 4))
    rest = F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), lambda a, c: F.when(c.between("0", "9"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97)
    return rest == 1


def confirmed(kind: str, match: Column) -> Column:
    number = digits(match)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.lpad(F.ltrim(p, F.lit("0")), 3, "0") <= "255"))
    if kind == "card":
        return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(number).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(match, F.lit(" "), F.lit("")))
    if kind == "national":
        return ~match.rlike("^(000|666|9)") & ~match.contains("-00-") & ~match.endswith("-0000")
    return F.lit(True)


def spans_of(kind: str, text: Column) -> Column:
    """array<struct<kind, start, end, score>>, ends exclusive, in code points.

    What lies between the matches gives their places.
    """
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, b: F.struct(m.alias("m"), F.char_length(b).alias("gap"), F.char_length(m).alias("n")))
    start = F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<m:string,start:int,end:int>>").alias("out")),
        lambda a, p: F.struct((a["at"] + p["gap"] + p["n"]).alias("at"), F.concat(a["out"], F.array(F.struct(p["m"].alias("m"), (a["at"] + p["gap"]).alias("start"), (a["at"] + p["gap"] + p["n"]).alias("end")))).alias("out")),
        lambda a: a["out"])
    valid = F.filter(start, lambda s: confirmed(kind, s["m"]))

    def scored(s: Column) -> Column:
        first = F.greatest(F.lit(0), s["start"] - NEAR_CHARS)
        near = F.lower(F.concat(F.substr(text, first + 1, s["start"] - first), F.lit(" "), F.substr(text, s["end"] + 1, F.lit(NEAR_CHARS))))
        score = F.lit(PRIOR[kind]) + F.when(near.rlike(rf"\b(?:{CONTEXT[kind]})"), NEAR).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.least(score, F.lit(1.0)).alias("score"))

    spans = F.transform(valid, scored)
    if kind not in BASE:
        spans = F.filter(spans, lambda s: s["score"] >= NEEDED)
    return spans


NONE = "array<struct<kind:string,start:int,end:int,score:double>>"


def with_spans(df: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Add `out`: all spans of the text by kind as listed in PATTERNS, then start.

    Null texts count as empty and have none. Long texts are searched whole, in
    time that grows with their length.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    df = df.withColumn("__text", whole)
    columns = []
    for kind, pattern in PATTERNS.items():
        there = F.col("__text").rlike(pattern)
        if kind in SIGNS:
            there = F.col("__text").contains(SIGNS[kind]) & there
        df = df.withColumn(f"__{kind}", F.when(there, spans_of(kind, F.col("__text"))).otherwise(F.array().cast(NONE)))
        columns.append(f"__{kind}")
    return df.withColumn(out, F.concat(*columns)).drop("__text", *columns)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts and places of personal data in each document; repeated rows stay rows."""
    df = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = [of_kind(k).alias(f"n_{k}") for k in BASE]
    return df.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, mask: str = "[PII]") -> DataFrame:
    """`docs` with spans in text replaced by `mask` and n_chars, where there is one, counted anew.

    Spans that overlap are replaced together. Null texts stay null.
    """
    df = with_spans(docs, "text", "__spans").withColumn("__spans", F.array_sort(F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))))
    text = F.col("text")
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        fresh = F.concat(a["out"], F.array(F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mask)))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], fresh).otherwise(a["out"]).alias("out"))

    new = F.aggregate("__spans", state, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1)))
    df = df.withColumn("text", F.when(F.size("__spans") > 0, new).otherwise(text)).drop("__spans")
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return df.select(*docs.columns)
