"""Sources: table scans by date, run or emptiness, API records and saved pages."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.functions.dictionaries import URL_CATEGORIES
from vireo.functions.text import one_space, stripped, url_without_query, without_tags

#: Columns a posting needs filled before its description is taken as structured.
WORK_FIELDS = ("job_title", "experience", "level", "education_level", "job_type", "work_mode", "company_industry", "job_requirement")

#: The text of a heading's block has more and fewer characters than these.
BLOCK = (50, 8000)

def staged(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Processed staging rows, all or those scraped on a day."""
    df = spark.read.parquet(path).where("ai_processed")
    return df if day is None else scraped_on(df, day)


def scraped_on(df: DataFrame, day: str, column: str = "scraped_at") -> DataFrame:
    return df.where(F.to_date(column) == F.to_date(F.lit(day)))


def day_of(column: Column) -> Column:
    """The day of a time, which may be text with further digits or a zone after the date; null where there is none."""
    return F.try_to_date(F.substring(F.trim(column.cast("string")), 1, 10), "yyyy-MM-dd")


def write_by_day(df: DataFrame, path: str, column: str = "scraped_at", day: str = "scrape_day") -> None:
    """Write rows into a folder a day, so that a later scan of some days opens no other; of the days that `df` has, all rows are replaced.

    Rows of one day are spread over tasks as their number asks, however many share the day.
    """
    rows = df.withColumn(day, day_of(F.col(column))).hint("rebalance", day)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def of_days(staging: DataFrame, days: DataFrame, day: str = "scrape_day") -> DataFrame:
    """Rows of the days that the column `day` of `days` lists: the scan is pruned to them while it runs.

    The distinct days are broadcast; a century has 36,525, less than a megabyte.
    """
    return staging.join(F.broadcast(days.select(day).distinct()), day, "left_semi").select(*staging.columns)


def since(df: DataFrame, column: str, today: str, days: int) -> DataFrame:
    return df.where((F.col(column) >= F.date_sub(F.to_date(F.lit(today)), days)) & F.col(column).isNotNull())


def work_queue(df: DataFrame, site: str, fields: tuple[str, ...] = WORK_FIELDS, most: int = 50) -> DataFrame:
    """The oldest unprocessed rows of a site that lack any of the fields (a limit by purpose)."""
    blank = F.lit(False)
    for f in fields:
        blank = blank | (F.coalesce(F.trim(f), F.lit("")) == "")
    return df.where((F.col("website") == site) & ~F.coalesce("ai_processed", F.lit(False)) & blank).orderBy("scraped_at", "id").limit(most)


def unseen(df: DataFrame, known: DataFrame, key: str = "job_url") -> DataFrame:
    return df.join(known.select(key).distinct(), key, "left_anti")


def in_categories(df: DataFrame, column: str, parts: tuple[str, ...] = URL_CATEGORIES) -> DataFrame:
    """Rows whose URL (without its query) holds one of the parts."""
    url = url_without_query(F.col(column))
    return df.where(reduce(lambda a, b: a | b, [url.contains(p) for p in parts]))


def page_fields(pages: DataFrame) -> DataFrame:
    """url and title of saved pages, and the text of the first heading's block."""
    title = without_tags(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    heading = without_tags(F.regexp_extract("html", r"(?is)<h[123][^>]*>(.*?)</h[123]>", 1))
    block = without_tags(F.regexp_extract("html", r"(?is)</h[123]>(.*?)(?=<h[123][\s>]|</article>|</section>|</body>|\z)", 1))
    return pages.select("page_id", "url", title.alias("title"), heading.alias("heading"), F.when((F.length(block) > BLOCK[0]) & (F.length(block) < BLOCK[1]), block).alias("block"))


class Outline(HTMLParser):
    """The text pieces of a page, of each div and section the pieces it spans, and the h2 and h3 headings."""

    FRAMES, HEADINGS = ("div", "section"), ("h2", "h3")

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.spans: dict[int, list[int]] = {}
        self.headings: list[tuple[int, int, list[int]]] = []
        self._open: list[tuple[str, int]] = []
        self._code = False
        self.feed(page)
        self.close()
        while self._open:
            self._end()

    def _end(self) -> None:
        tag, at = self._open.pop()
        if tag in self.FRAMES:
            self.spans[at][1] = len(self.pieces)
        else:
            self.headings.append((at, len(self.pieces), [a for t, a in self._open if t in self.FRAMES]))

    def handle_starttag(self, tag, attrs) -> None:
        self._code = tag in ("script", "style")
        if tag in self.FRAMES:
            at = len(self.spans)
            self.spans[at] = [len(self.pieces), -1]
            self._open.append((tag, at))
        elif tag in self.HEADINGS:
            self._open.append((tag, len(self.pieces)))

    def handle_endtag(self, tag) -> None:
        self._code = False
        if any(t == tag for t, _ in self._open):
            while self._open[-1][0] != tag:
                self._end()
            self._end()

    def handle_data(self, data) -> None:
        if data.strip() and not self._code:
            self.pieces.append(data.strip())


def block_under(page: str | None, sought: str) -> str | None:
    """The text of the nearest div or section around the first h2 or h3 that holds `sought`
    (in any case), outwards until one is within BLOCK; headings without one are passed over."""
    found = Outline(page or "")
    for start, end, around in sorted(found.headings):
        if sought.lower() in "".join(found.pieces[start:end]).lower():
            for frame in reversed(around):
                text = "\n".join(found.pieces[slice(*found.spans[frame])])
                if BLOCK[0] < len(text) < BLOCK[1]:
                    return text
    return None


def heading_blocks(pages: DataFrame, sought: str) -> DataFrame:
    """page_id and block, the text around the heading that holds `sought` (null: none)."""
    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([block_under(h, sought) for h in batch.column(1).to_pylist()], pa.string())], names=["page_id", "block"])

    return pages.selectExpr("cast(page_id as long) page_id", "cast(html as string) html").mapInArrow(read, "page_id long, block string")


def detail_else_card(details: DataFrame, cards: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Detail pages' values, and where blank those of the list's card (or the company's page)."""
    named = cards.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    both = details.join(named, key, "left")
    return both.select(*[F.coalesce(F.nullif(one_space(F.col(c)), F.lit("")), F.col(f"__{c}")).alias(c) if c in columns else F.col(c) for c in details.columns])
