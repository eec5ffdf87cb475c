"""Field parsers of job postings, all native Column expressions.

Each takes Columns of raw text and gives Columns; parsers whose steps feed each
other take a DataFrame and add columns, so that each step is computed once.
Null is read as empty. Deviations from the behaviour they replace: four-group
amounts (`1.000.000.000`) are read whole; `php` is not an hourly mark; "0 năm
kinh nghiệm" means none only where no digit stands before the 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.functions import dictionaries as d
from vireo.functions import keywords as k
from vireo.functions.keywords import Place
from vireo.functions.text import between_non_words, first_label, lowered, numbers, one_space, stripped, without_accents

UNICODE = "(?iU)"
SECONDS = {"second": 1, "giây": 1, "minute": 60, "phút": 60, "hour": 3600, "giờ": 3600, "day": 86400, "ngày": 86400, "week": 604800, "tuần": 604800, "month": 30 * 86400, "tháng": 30 * 86400, "year": 365 * 86400, "năm": 365 * 86400}


def group(c: Column, pattern: str, n: int) -> Column:
    """Group n of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(c, pattern, n), F.lit(""))


def found(c: Column, words: list[str]) -> Column:
    return k.holds(c, words)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of the value, which is computed once however often it is named: an array of one holds it."""
    return F.transform(F.array(value), use)[0]


def website(raw: Column) -> Column:
    return lowered(raw)


# Dates -------------------------------------------------------------------------


# A text that a date format cannot read costs an exception, some 20 us; so a pattern stands before each reading.


def timestamp_of(ref: Column) -> Column:
    at = F.replace(F.substring(stripped(ref), 1, 19), F.lit(" "), F.lit("T"))
    return F.when(at.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\z"), F.try_to_timestamp(at, F.lit("yyyy-MM-dd'T'HH:mm:ss")))


def moment(ref: Column) -> Column:
    """The reference time, also where only a date is given."""
    day = F.substring(stripped(ref), 1, 10)
    return F.coalesce(timestamp_of(ref), F.when(day.rlike(r"^\d{4}-\d\d-\d\d\z"), F.try_to_timestamp(day, F.lit("yyyy-MM-dd"))))


def written(text: Column, pattern: str, order: str) -> Column:
    """The day at the beginning of the text, `order` its groups as year-month-day; null if there is none or no such day."""
    return F.when(text.rlike(pattern), F.regexp_replace(F.regexp_extract(text, pattern, 0), pattern, order).try_cast("date"))


def shifted(ref: Column, count: Column, unit: Column, sign: int) -> Column:
    """The date `count` units before (sign -1) or after; a month is 30 days, a year 365."""
    seconds = F.element_at(F.create_map(*[F.lit(x) for kv in SECONDS.items() for x in kv]), unit)
    return F.to_date(F.timestamp_seconds(F.unix_timestamp(moment(ref)) + sign * count.try_cast("long") * seconds))


def date_of(text: Column, ref: Column) -> Column:
    """A date written d/m/Y, Y-m-d, as days left, or as time ago in English or Vietnamese; else null."""
    dmy, iso = r"^(\d{1,2})[/\-](\d{1,2})[/\-](\d{4})", r"^(\d{4})[/\-](\d{2})[/\-](\d{2})"
    left, ago, truoc = r"(?U)còn\s+(\d+)\s+ngày", r"(\d+)\s+(second|minute|hour|day|week|month|year)s?\s+ago", r"(?U)(\d+)\s+(giây|phút|giờ|ngày|tuần|tháng|năm)(?:\s+trước)?"

    def read(s: Column) -> Column:
        day = F.coalesce(
            written(s, dmy, "$3-$2-$1"), written(s, iso, "$1-$2-$3"),
            F.when(s.rlike(left), shifted(ref, group(s, left, 1), F.lit("day"), 1)), F.when(s.rlike(ago), shifted(ref, group(s, ago, 1), group(s, ago, 2), -1)), F.when(s.rlike(truoc), shifted(ref, group(s, truoc, 1), group(s, truoc, 2), -1)))
        return F.when(s.rlike(r"(?U)\d"), day)

    return once(F.trim(F.regexp_replace(lowered(text), r"\(.*?\)", "")), read)


def dates(posted: Column, deadline: Column, scraped_at: Column, description: Column) -> dict[str, Column]:
    leads, day = (r"hạn\s+nộp", "deadline", r"ngày\s+hết\s+hạn", r"apply\s+before"), r"[:\s]+(\d{1,2}[/\-]\d{1,2}[/\-]\d{4})"

    def named(text: Column) -> Column:
        # Most texts name no date: one pass finds that out. A date found is written d/m/Y, as date_of would read it.
        each = [written(F.regexp_extract(text, rf"(?U){lead}{day}", 1), r"^(\d{1,2})[/\-](\d{1,2})[/\-](\d{4})", "$3-$2-$1") for lead in leads]
        return F.when(text.rlike(rf"(?U)(?:{'|'.join(leads)}){day}"), F.coalesce(*each))

    return {"job_posted_at_clean": F.coalesce(date_of(posted, scraped_at), F.to_date(moment(scraped_at))), "job_deadline_clean": F.coalesce(date_of(deadline, scraped_at), once(lowered(description), named))}


def day_first(text: Column) -> Column:
    """Y-m-d as d/m/Y, what follows a d/m/Y dropped, anything else as it is."""
    s = stripped(text)
    iso = r"^(\d{4})-(\d{2})-(\d{2})"
    return F.coalesce(F.when(s.rlike(iso), F.regexp_replace(F.regexp_extract(s, iso, 0), iso, "$3/$2/$1")), group(s, r"^(\d{2}/\d{2}/\d{4})", 1), s)


def relative_day(text: Column, scraped_at: Column) -> Column:
    """English time ago ("reposted", "posted" allowed before it) or "just now" as d/m/Y, else as it is."""
    s = F.regexp_replace(F.regexp_replace(lowered(text), r"(?U)^reposted\s+", ""), r"(?U)^posted\s+", "")
    ago = r"^(\d+)\s+(second|minute|hour|day|week|month|year)s?\s+ago"
    at = F.when(s.rlike(ago), shifted(scraped_at, group(s, ago, 1), group(s, ago, 2), -1)).when(s.contains("just now"), F.to_date(moment(scraped_at)))
    return F.coalesce(F.date_format(at, "dd/MM/yyyy"), text, F.lit(""))


def iso_posted(text: Column, scraped_at: Column) -> Column:
    """English time ago, or "just now", as Y-m-d; else null."""
    return F.date_format(F.when(lowered(text).contains("just now"), F.to_date(moment(scraped_at))).otherwise(date_of(text, scraped_at)), "yyyy-MM-dd")


def is_old(text: Column, ref: Column, more_than_days: int) -> Column:
    """Whether the posting is more than so many days old; unreadable text is not."""
    at = date_of(text, ref)
    return F.coalesce(F.datediff(F.to_date(moment(ref)), at) > more_than_days, F.lit(False))


# Title -------------------------------------------------------------------------


def title_clean(raw: Column) -> Column:
    s = stripped(raw)
    for noise in d.TITLE_NOISE:
        s = F.regexp_replace(s, UNICODE + noise, " ")
    return one_space(F.regexp_replace(F.regexp_replace(s, r"[-–—,;/|_]+$", ""), r"^[-–—,;/|_]+", ""))


def title_detected(title: Column, vocabulary: d.Vocabulary) -> Column:
    """The first fixed title, else that of the first role and domain, else the first of the further titles."""
    text = F.lower(title)
    roles, domains = (F.coalesce(k.first_group(text, groups, Place.INSIDE), F.lit(-1)) for groups in (d.ROLES, d.DOMAINS))
    number = {label: i for groups in (d.ROLES, d.DOMAINS) for i, (label, _) in enumerate(groups)}
    pairs = {f"{number[role]}/{number[domain]}": label for (role, domain), label in d.ROLE_DOMAIN_TITLES.items()}
    both = F.try_element_at(k.constant(pairs, "map<string, string>"), F.concat_ws("/", roles, domains))
    titles = [(label, [w.lower() for w in words]) for label, words in (*d.TITLES, *vocabulary.titles())]
    # A one-element array names the number, so that the search for titles runs once.
    found = F.transform(F.array(k.first_group(text, titles, Place.ALONE)), lambda i: F.when(i < len(d.TITLES), k.label_of(i, titles)).otherwise(F.coalesce(both, k.label_of(i, titles))))
    return found[0]


def with_title(df: DataFrame, raw: str = "job_title", vocabulary: d.Vocabulary | None = None) -> DataFrame:
    """job_title_clean, job_title_detect, job_category_clean, is_it."""
    vocabulary = vocabulary or d.Vocabulary()
    df = df.withColumn("__raw", stripped(raw)).withColumn("__clean", title_clean(F.col("__raw")))
    df = df.withColumn("job_title_detect", F.coalesce(title_detected(F.col("__clean"), vocabulary), F.when(F.col("__raw") != F.col("__clean"), title_detected(F.col("__raw"), vocabulary))))
    df = df.withColumn("job_title_clean", F.when(F.col("__clean") != "", F.col("__clean")).otherwise(F.col("__raw")))
    category = k.named(F.col("job_title_detect"), d.TITLE_CATEGORIES.items())
    signal = F.col("job_title_detect").isNull() & found(F.lower("job_title_clean"), list(dict.fromkeys([*(w for _, ws in d.DOMAINS for w in ws), *d.IT_SIGNALS])))
    df = df.withColumn("__category", category).withColumn("__signal", signal)
    df = df.withColumn("is_it", F.col("__category").isNotNull() | F.col("__signal"))
    df = df.withColumn("job_category_clean", F.coalesce("__category", F.when(F.col("__signal"), "IT - Khác"), F.lit("Non-IT")))
    return df.drop("__raw", "__clean", "__category", "__signal")


# Company -----------------------------------------------------------------------


def company_key(name: Column) -> Column:
    s = F.split(stripped(name), r"(?U)\s*[-–—|]\s*(?=\S{20,}|\w[\w\s]{15,})", 2)[0]
    s = F.regexp_replace(s, r"\([^)]{0,40}\)", " ")
    for _ in range(3):
        s = F.regexp_replace(s, UNICODE + d.LEGAL_WORDS, " ")
    s = F.regexp_replace(F.lower(without_accents(s)), r"[^a-z0-9\s]", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def company(raw: Column) -> dict[str, Column]:
    s = stripped(raw)
    low = F.lower(s)
    unknown, hidden = low.isin("", "null", "n/a", "none", "nan"), low.rlike(UNICODE + d.CONFIDENTIAL)
    name = s
    for pattern, form in reversed(d.COMPANY_FORMS):
        name = F.when(s.rlike(UNICODE + pattern), F.regexp_replace(s, UNICODE + pattern, form)).otherwise(name)
    kind = first_label(low, [(label, "(?U)" + p) for label, p in d.COMPANY_TYPES], "Khác")
    pick = lambda value: F.when(unknown, "Unknown").when(hidden, "Confidential").otherwise(value)
    key = company_key(name)
    return {"company_title_clean": pick(F.upper(name)), "company_type": pick(kind), "company_canonical_key": F.when(~unknown & ~hidden & (key != ""), key)}


# Place -------------------------------------------------------------------------


def province_of(part: Column) -> Column:
    keys = sorted(((p, [key]) for p, ks in d.PROVINCES.items() for key in ks), key=lambda x: -len(x[1][0]))
    ladder = lambda text: k.first_label(text, keys, Place.INSIDE)
    low = F.trim(F.lower(part))
    return F.coalesce(ladder(low), ladder(F.trim(F.regexp_replace(low, UNICODE + d.PLACE_WORDS, " "))))


def region_of(province: Column) -> Column:
    return F.coalesce(k.named(province, d.REGIONS.items()), F.lit(d.OTHER_PLACE))


def with_places(df: DataFrame, raw: str = "location") -> DataFrame:
    """`places`: array of the provinces that a posting names, `Khác` once for all that
    are unknown (and where none is given); null where it names more than nine places."""
    s = F.regexp_replace(stripped(raw), r"(?iU),?\s*viet\s*nam\s*$", "")
    s = F.regexp_replace(F.trim(s), r"(?iU)(?:phường|xã|thị trấn|quận|huyện|district|ward)\s+[\w\s]+?(?=[,;|]|$)", "")
    s = F.regexp_replace(s, "^[ ,;]+|[ ,;]+$", "")
    parts = F.filter(F.transform(F.split(s, r"(?U)[;,|&]|\s+[-–]\s+"), lambda p: stripped(p)), lambda p: p != "")
    df = df.withColumn("__parts", parts)
    named = F.array_distinct(F.transform("__parts", lambda p: F.coalesce(province_of(p), F.lit(d.OTHER_PLACE))))
    return df.withColumn("places", F.when(F.size("__parts") > 9, None).when(F.size("__parts") == 0, F.array(F.lit(d.OTHER_PLACE))).otherwise(named)).drop("__parts")


def fanned_out(df: DataFrame) -> DataFrame:
    """A row for each of `places`: location_province, location_region, is_vn. Rows without places go."""
    df = df.withColumn("location_province", F.explode("places")).drop("places")
    return df.withColumn("location_region", region_of(F.col("location_province"))).withColumn("is_vn", F.col("location_province") != d.OTHER_PLACE)


def work_style(kind: Column, mode: Column, description: Column) -> dict[str, Column]:
    full = F.lower(F.concat_ws(" ", stripped(kind), stripped(mode), F.substring(stripped(description), 1, 500)))
    return {"job_type_clean": k.first_label(full, d.WORK_TYPES, Place.INSIDE, "Full-time"), "work_mode_clean": k.first_label(full, d.WORK_MODES, Place.INSIDE, "Onsite")}


# Salary ------------------------------------------------------------------------


def currency_of(text: Column) -> Column:
    thousands = text.rlike(r"\d\s*[kK]\b") & ~text.rlike(UNICODE + r"triệu|triêu|đồng|vnđ|vnd|\bđ\b")
    return F.coalesce(first_label(text, [(c, UNICODE + p) for c, p, *_ in d.CURRENCIES]), F.when(thousands, "USD"), F.lit("VND"))


def by_currency(currency: Column, at: int) -> Column:
    out = F.lit(None).cast("double")
    for row in d.CURRENCIES:
        out = F.when(currency == row[0], F.lit(float(row[at]))).otherwise(out)
    return out


def period_of(text: Column) -> Column:
    yearly, monthly, hourly = (text.rlike(UNICODE + p) for p in (d.YEARLY, d.MONTHLY, d.HOURLY))
    return F.when(yearly & ~monthly & ~hourly, "year").when(hourly, "hour").otherwise("month")


def plain_numbers(text: Column) -> Column:
    """Thousands marks out, decimal commas to points."""
    text = F.regexp_replace(text, r"(?<=\d)[.](?=\d{3}(?!\d))", "")
    text = F.regexp_replace(text, r"(?<=\d),(?=\d{3}(?!\d))", "")
    return F.replace(text, F.lit(","), F.lit("."))


def amounts(text: Column, currency: Column) -> Column:
    """All amounts in ascending order: ranges with one suffix, numbers with a suffix, bare numbers."""
    number, suffix = r"\d+(?:[.,]\d+)?", r"(?:triệu|triêu\b|tr\b|[kKmM](?!\w))"
    ranged = rf"(?U){number}\s*-\s*{number}\s*(?:triệu|triêu\b|tr\b|[kKmMđ](?!\w))"
    t = F.regexp_replace(text, r"\b\d{1,2}[/\-]\d{1,2}[/\-]\d{4}\b|\b\d{4}[/\-]\d{2}[/\-]\d{2}\b", " ")
    t = plain_numbers(F.regexp_replace(t, "[~–—]", "-"))
    scale = lambda m: F.when(m.rlike(r"(?U)(?:triệu|triêu|tr|[mM])$"), 1e6).when(m.rlike("[kK]$"), 1e3).otherwise(1.0)
    ranges = F.regexp_extract_all(t, F.lit(f"({ranged})"), F.lit(1))
    t = F.regexp_replace(t, ranged, " ; ")
    singles = F.regexp_extract_all(t, F.lit(rf"(?U)({number}\s*{suffix})"), F.lit(1))
    t = F.regexp_replace(t, rf"(?U){number}\s*{suffix}", " ; ")
    bare = F.filter(numbers(t), lambda x: (currency != "VND") | (x >= 100))
    valued = lambda m: F.transform(numbers(m), lambda x: x * scale(m))
    return F.filter(F.array_sort(F.concat(F.flatten(F.transform(ranges, valued)), F.flatten(F.transform(singles, valued)), bare)), lambda x: x.isNotNull())


def with_salary(df: DataFrame, raw: str = "compensation") -> DataFrame:
    """salary_min, salary_max (whole amounts a month in the original currency),
    salary_currency, conversion_rate, is_negotiable, salary_type."""
    main = r"(?is)^(.*?\d.*?)(?:\.\s+[A-ZÀÁÂÃÈÉÊÌÍÒÓÔÕÙÚĂĐ]|\n|;|,\s+(?:including|plus|with|and\s+(?:bonus|benefits?)))"
    df = df.withColumn("__s", stripped(raw)).withColumn("__text", F.lower("__s"))
    df = df.withColumn("__main", F.lower(F.coalesce(group(F.col("__s"), main, 1), F.col("__s"))))
    text, first = F.col("__text"), F.col("__main")
    df = df.withColumn("__cur", currency_of(text)).withColumn("__period", period_of(text)).withColumn("__n", amounts(first, F.col("__cur")))
    df = df.withColumn("__n", F.filter(F.when(F.size("__n") > 0, F.col("__n")).otherwise(amounts(text, F.col("__cur"))), lambda x: x > 0))
    open_ = (F.col("__s") == "") | found(text, d.NEGOTIABLE) & ~first.rlike(r"\d") | (F.size("__n") == 0)
    up_to = found(first, d.UP_TO_WORDS) | first.rlike(r"\bup[\s\-]+to\b")
    low_only, one = found(first, d.FROM_WORDS) & ~up_to, F.size("__n") == 1
    least, most = F.get("__n", F.lit(0)), F.element_at(F.when(F.size("__n") > 0, F.col("__n")), -1)
    df = df.withColumn("__lo", F.when(~(one & up_to), least)).withColumn("__hi", F.when(~(one & low_only), most)).withColumn("__open", open_)
    factor = F.when(F.col("__period") == "year", 1 / 12).when(F.col("__period") == "hour", 160.0).otherwise(1.0)
    for c in ("__lo", "__hi"):
        df = df.withColumn(c, F.when(F.col("__period") == "month", F.col(c)).otherwise(F.round(F.col(c) * factor, 2)))
    df = df.withColumn("__floor", by_currency(F.col("__cur"), 3)).withColumn("__ceil", by_currency(F.col("__cur"), 4))
    month = F.col("__period") == "month"
    yearly = month & (F.col("__lo") > F.col("__ceil"))
    small = month & ~F.coalesce(yearly, F.lit(False)) & (F.col("__hi") < F.col("__floor")) & (F.col("__hi") < 10_000) & (F.col("__cur") == "VND")
    df = df.withColumn("__rescue", F.when(yearly, 1 / 12).when(small, 1000.0).otherwise(1.0))
    for c in ("__lo", "__hi"):
        value = F.when(F.col("__rescue") == 1, F.col(c)).otherwise(F.round(F.col(c) * F.col("__rescue"), 2))
        df = df.withColumn(c, F.when(value.between(F.col("__floor"), F.col("__ceil")), value))
    known = ~F.col("__open") & (F.col("__lo").isNotNull() | F.col("__hi").isNotNull())
    both = F.col("__lo").isNotNull() & F.col("__hi").isNotNull()
    kind = F.when(text.rlike(UNICODE + d.YEARLY), "yearly").when(text.rlike(UNICODE + d.HOURLY), "hourly").when(text.rlike(UNICODE + d.PER_TASK), "per_task").otherwise("monthly")
    df = df.withColumns({
        "salary_min": F.when(known, F.when(both, F.least("__lo", "__hi")).otherwise(F.col("__lo")).cast("long")), "salary_max": F.when(known, F.when(both, F.greatest("__lo", "__hi")).otherwise(F.col("__hi")).cast("long")),
        "salary_currency": F.when(known, F.col("__cur")), "conversion_rate": F.when(known, by_currency(F.col("__cur"), 2)), "is_negotiable": ~known, "salary_type": F.when(known, kind).otherwise("negotiable")})
    return df.drop("__s", "__text", "__main", "__cur", "__period", "__n", "__lo", "__hi", "__open", "__floor", "__ceil", "__rescue")


# Experience and level -------------------------------------------------------------


def years_in(text: Column, most: float | None = None) -> Column:
    """struct<lo, hi, needed> read from a text that holds numbers; null where it holds none."""
    n = numbers(text)
    if most is not None:
        n = F.filter(n, lambda x: x <= most)
    n = F.when(text.contains("tháng") & ~text.contains("năm"), F.transform(n, lambda x: F.round(x / 12, 2))).otherwise(n)
    first, second, none = F.get(n, F.lit(0)), F.get(n, F.lit(1)), F.lit(None).cast("double")
    made = lambda lo, hi: F.struct(lo.cast("double").alias("lo"), hi.cast("double").alias("hi"), F.lit(True).alias("needed"))
    return (F.when(F.size(n) == 0, None).when(text.contains("dưới 1"), made(F.lit(0), F.lit(1)))
            .when(found(text, d.EXPERIENCE_OVER) | text.rlike(r"\d+\+"), made(first, none)).when(found(text, d.EXPERIENCE_UNDER), made(F.lit(0), first))
            .when(F.size(n) >= 2, made(F.least(first, second), F.greatest(first, second))).otherwise(made(first, first)))


def no_experience(text: Column) -> Column:
    return found(text, d.NO_EXPERIENCE) | text.rlike(r"(?<!\d)0 năm kinh nghiệm")


def with_experience(df: DataFrame, raw: str = "experience", description: str = "job_description", requirement: str = "job_requirement") -> DataFrame:
    """exp_min_yr, exp_max_yr, is_exp_required."""
    point = lambda c: F.regexp_replace(c, r"(\d),(\d)(?!\d)", "$1.$2")
    none = F.struct(F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi"), F.lit(False).alias("needed"))
    read = lambda t, most=None: F.when(no_experience(t), none).otherwise(years_in(t, most))
    df = df.withColumn("__exp", point(lowered(raw)))
    candidates = []
    for i, source in enumerate((requirement, description)):
        sentences = F.filter(F.transform(F.split(point(lowered(source)), r"[.\n\r]"), lambda x: F.trim(x)), lambda x: x.rlike(UNICODE + d.EXPERIENCE_SENTENCE))
        df = df.withColumn(f"__in{i}", F.get(F.filter(F.transform(sentences, lambda x: read(x, 50.0)), lambda x: x.isNotNull()), F.lit(0)))
        candidates.append(F.col(f"__in{i}"))
    df = df.withColumn("__years", F.coalesce(F.when(F.col("__exp") != "", read(F.col("__exp"))), *candidates))
    return df.withColumns({"exp_min_yr": F.col("__years.lo"), "exp_max_yr": F.col("__years.hi"), "is_exp_required": F.col("__years.needed")}).drop("__exp", "__in0", "__in1", "__years")


def binned(value: Column, bins: list[tuple[float, float | None, str]], default: str | None = None) -> Column:
    """The label of lo <= value < hi (a bin with lo = hi holds just that value)."""
    out = F.lit(default).cast("string")
    for lo, hi, label in reversed(bins):
        inside = (value == lo) if lo == hi else (value >= lo) & (F.lit(True) if hi is None else value < hi)
        out = F.when(inside, F.lit(label)).otherwise(out)
    return out


def level_in(text: Column) -> Column:
    def pattern(words: list[str]) -> str:
        plain, special = [w for w in words if "\\" not in w], [w for w in words if "\\" in w]
        return "|".join([between_non_words(plain), *["(?U)" + w for w in special]])

    return first_label(F.lower(text), [(label, pattern(words)) for label, words in d.LEVELS])


def level(raw: Column, title: Column, low: Column, high: Column, description: Column, requirement: Column) -> Column:
    head = lambda c: F.substring(stripped(c), 1, 500)
    mean = F.when(low.isNotNull() | high.isNotNull(), (F.coalesce(low, F.lit(0.0)) + F.coalesce(F.when(high != 0, high), low, F.lit(0.0))) / 2)
    return F.coalesce(level_in(stripped(raw)), level_in(stripped(title)), level_in(head(description)), level_in(head(requirement)), binned(mean, d.LEVEL_YEARS), F.lit("Unknown"))


# Description -----------------------------------------------------------------------


def joined(labels: Column) -> Column:
    return F.when(F.size(labels) > 0, F.array_join(labels, ", "))


def with_description_fields(df: DataFrame, vocabulary: d.Vocabulary | None = None) -> DataFrame:
    """hard_skills, soft_skills, major, certifications, languages from description, requirement and (but for two sites) category."""
    vocabulary = vocabulary or d.Vocabulary()
    category = F.when(~lowered("website").isin("linkedin", "itviec"), lowered("job_category"))
    df = df.withColumn("__full", F.concat_ws(" ", lowered("job_description"), lowered("job_requirement"), category))
    # Two searches serve four lists of groups: one for whole words, one for keywords inside words too.
    hard, certificates = vocabulary.hard_skills(), [(x, [x]) for x in d.CERTIFICATES]
    whole, inside = k.words_of(hard, d.SOFT_SKILLS), k.words_of(certificates, d.MAJORS)
    df = df.withColumn("__whole", k.hits(F.col("__full"), whole, Place.WORD)).withColumn("__inside", k.hits(F.col("__full"), inside, Place.INSIDE))
    skills = lambda groups: joined(k.labels_of_hits(F.col("__whole"), groups, Place.WORD, whole))
    df = df.withColumn("__certs", k.labels_of_hits(F.col("__inside"), certificates, Place.INSIDE, inside))
    of = {c: lang for lang, cs in d.LANGUAGE_CERTIFICATES.items() for c in cs}
    languages = F.array_sort(F.array_distinct(F.filter(F.transform("__certs", lambda c: F.element_at(F.create_map(*[F.lit(x) for kv in of.items() for x in kv]), c)), lambda x: x.isNotNull())))
    return df.withColumns({
        "hard_skills": skills(hard), "soft_skills": skills(d.SOFT_SKILLS), "major": k.label_of(k.group_of_hits(F.col("__inside"), d.MAJORS, Place.INSIDE, inside), d.MAJORS),
        "certifications": joined(F.col("__certs")), "languages": joined(languages)}).drop("__full", "__whole", "__inside", "__certs")


def education(raw: Column, description: Column, requirement: Column) -> Column:
    return F.coalesce(*[k.first_label(lowered(c), d.EDUCATION, Place.INSIDE) for c in (raw, requirement, description)], F.lit(d.NO_EDUCATION))


def company_size(raw: Column) -> dict[str, Column]:
    text = F.regexp_replace(lowered(raw), "[.,]", "")
    n = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("long"))
    first, low, high = F.get(n, F.lit(0)), F.array_min(n), F.array_max(n)
    under, over, blank = found(text, ["dưới", "ít hơn", "less than"]), found(text, ["trên", "hơn", "over", "+"]), (F.size(n) == 0) | text.isin("null", "n/a")
    return {"company_size_min": F.when(blank, None).when(under, F.lit(0)).when(over, first).otherwise(low), "company_size_max": F.when(blank, None).when(under, first).when(over, None).otherwise(high)}


def industry(raw: Column, major: Column, strict_words: bool = False) -> dict[str, Column]:
    """Keywords are found inside words too, unless `strict_words`."""
    text = F.concat_ws(" ", lowered(raw), lowered(major))
    place = Place.ALONE if strict_words else Place.INSIDE
    pick = lambda at: k.first_label(text, [(row[at], row[2]) for row in d.INDUSTRIES], place, d.UNKNOWN_INDUSTRY)
    return {"industry_level1": pick(0), "industry_level2": pick(1)}


def headcount(raw: Column, title: Column) -> Column:
    s = F.when(~F.upper(stripped(raw)).isin("NULL", "N/A", "NONE"), lowered(raw)).otherwise("")
    given = F.filter(F.transform(F.regexp_extract_all(s, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("int")), lambda x: (x > 0) & (x < 1000))
    t = lowered(title)
    named = F.filter(F.array(*[group(t, "(?U)" + p, 1).try_cast("int") for p in d.HEADCOUNT_TITLES]), lambda x: (x >= 1) & (x < 200))
    return F.coalesce(F.when(found(s, d.HEADCOUNT_MANY), F.lit(999)), F.array_max(given), F.array_max(named), F.lit(1)).cast("long")


def education_evidence(claimed: Column, description: Column, requirement: Column) -> Column:
    """A claimed education only where the text names it or any other; else null."""
    text = F.concat_ws(" ", lowered(description), lowered(requirement))
    return F.when(found(text, [w for _, ws in d.EDUCATION for w in ws]), claimed)


def years_at_source(text: Column) -> Column:
    return group(lowered(text), r"(?U)(\d+)\+?\s*years?(?:\s+of)?\s+experience", 1)


def level_in_title(title: Column) -> Column:
    """The first listed level word that the title holds, capitalised; else null."""
    low = lowered(title)
    return F.coalesce(*[F.when(low.contains(word), F.lit(word.capitalize())) for word in d.TITLE_LEVELS])
