"""Every operator of the library on whole tables, beside the SQL that says what it should give."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vireo import schemas
from vireo.functions import dictionaries as d
from vireo.functions import keywords
from vireo.functions import parsers as p
from vireo.functions import text as t
from vireo.operators import lineage, linkage, linkage_state, upsert, versioned, windows
from vireo.plans import analytics, ingest, nightly, structuring, transform, warehouse
from vireo.sources import fields, replies
from vireo.sources import tables as sources
from vireo.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    """Register the function under its name, with its SQL."""
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


c = F.col

# Sources ---------------------------------------------------------------------------


@query("SELECT o_orderkey, trim(o_orderpriority, ' ') AS priority FROM orders WHERE o_orderpriority IS NOT NULL AND trim(o_orderpriority, ' ') <> '' AND o_orderstatus = 'F'")
def scan_filter_valid(table):
    return table("orders").where("o_orderpriority is not null and trim(o_orderpriority) <> '' and o_orderstatus = 'F'").select("o_orderkey", F.trim("o_orderpriority").alias("priority"))


@query("SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def scan_by_date(table):
    return sources.scraped_on(table("events"), "2024-01-10", "ts").select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND ts IS NOT NULL")
def scan_lookback(table):
    return sources.since(table("events"), "ts", "2024-01-30", 10).select("event_id", "user_id")


@query("""SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O' AND (o_orderkey % 3 = 0 OR o_custkey % 5 = 0) ORDER BY o_orderdate, o_orderkey LIMIT 50""")
def work_queue_topn(table):
    rows = table("orders").select(
        c("o_orderkey").alias("id"), c("o_orderstatus").alias("website"), F.lit(False).alias("ai_processed"), c("o_orderdate").alias("scraped_at"),
        F.when(c("o_orderkey") % 3 != 0, "x").alias("level"), F.when(c("o_custkey") % 5 != 0, "x").otherwise(" ").alias("experience"))
    return sources.work_queue(rows, "O", ("level", "experience")).select("id")


@query("SELECT url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0 AND url IS NOT NULL)")
def known_url_anti(table):
    return sources.unseen(table("pages"), table("pages").where("page_id % 3 = 0"), "url").select("url")


@query("SELECT event_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def batch_semi(table):
    events = table("events")
    return events.join(events.where("event_type = 'purchase'").select("user_id"), "user_id", "left_semi").select("event_id")


_API_SQL = """'https://j/' || p_partkey AS job_url, p_name AS job_title, p_brand AS company_title, CASE WHEN p_size % 2 = 0 THEN 'Hà Nội' END AS location, CAST(p_size AS VARCHAR) AS experience,
CASE WHEN p_size % 3 = 1 THEN format('{:,}', p_size * 1000) || ' - ' || format('{:,}', p_size * 2000) || ' USD' || CASE WHEN p_size % 2 = 0 THEN ' /năm' ELSE ' /tháng' END WHEN p_size % 3 = 0 THEN 'deal' ELSE 'Thỏa thuận' END AS compensation,
CASE WHEN p_size % 4 = 0 THEN 'IT' ELSE 'A' END AS job_category, 'Bank, Retail' AS company_industry, 'Do ' || p_type || chr(10) || chr(10) || 'Skills: ' || p_brand AS job_description, CASE WHEN p_size % 5 > 0 THEN 'Need' END AS job_requirement"""
_API = "job_url job_title company_title location experience compensation job_category company_industry job_description job_requirement".split()


def _api_record():
    """An API record of a part."""
    named = lambda field, *values: F.array(*[F.struct(F.lit(v).alias(field)) for v in values])
    pay = F.when(c("p_size") % 3 == 1, c("p_size") * 1000)
    return F.to_json(F.struct(
        F.concat(F.lit("https://j/"), "p_partkey").alias("jobUrl"), c("p_name").alias("jobTitle"), c("p_brand").alias("companyName"), F.when(c("p_size") % 2 == 0, named("cityNameVI", "Hà Nội", "Huế")).alias("workingLocations"), c("p_size").alias("yearsOfExperience"),
        F.when(c("p_size") % 3 == 0, "deal").alias("prettySalary"), pay.alias("salaryMin"), (pay * 2).alias("salaryMax"), F.lit("USD").alias("salaryCurrency"), F.when(c("p_size") % 2 == 0, 2).alias("salaryPeriodId"),
        named("industryV3NameVI", "Bank", " ", "Retail").alias("industriesV3"), F.struct(F.lit("IT").alias("parentNameVI"), F.when(c("p_size") % 4 > 0, named("nameVI", "A", "B")).alias("children")).alias("jobFunction"),
        F.concat(F.lit("<p>Do <b>"), "p_type", F.lit("</b></p>")).alias("jobDescription"), F.when(c("p_size") % 5 > 0, "<p>Need").alias("jobRequirement"), F.array(F.struct(c("p_brand").alias("skillName"))).alias("skills")))


@query(f"SELECT {_API_SQL} FROM part")
def api_json_flatten(table):
    return replies.postings(table("part").select(_api_record().alias("record"))).select(*_API)


def _api_replies(table):
    """Replies of 50 parts each, 20 pages a crawl: one in 7 is cut short, one in 11 was not saved; a record in 97 is no record."""
    key = c("p_partkey")
    rows = table("part").select(F.floor(key / 1000).alias("crawl"), (F.floor(key / 50) % 20).alias("page"), key, F.when(key % 97 == 0, F.lit('{"jobUrl": "https://j/x", "salaryMin": "much"}')).otherwise(_api_record()).alias("record"))
    body = F.concat(F.lit('{"meta": {"nbPages": 20}, "data": ['), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "record"))), lambda x: x["record"]), ", "), F.lit("]}"))
    pages = rows.groupBy("crawl", "page").agg(body.alias("body"))
    return pages.select("crawl", "page", F.when((c("crawl") + c("page")) % 7 == 3, F.expr("substring(body, 1, length(body) - 5)")).otherwise(c("body")).alias("body")).where((c("crawl") + c("page")) % 11 != 5)


_API_PAGES = """p AS (SELECT *, p_partkey // 1000 AS crawl, (p_partkey // 50) % 20 AS page FROM part), q AS (SELECT *, (crawl + page) % 7 = 3 AS cut, row_number() OVER (PARTITION BY crawl, page ORDER BY p_partkey) - 1 AS position FROM p WHERE (crawl + page) % 11 <> 5)"""


@query(f"""WITH {_API_PAGES} SELECT crawl, page, position, CAST(NULL AS VARCHAR) AS error, {_API_SQL} FROM q WHERE NOT cut AND p_partkey % 97 <> 0
UNION ALL SELECT crawl, page, position, 'record', 'https://j/x', NULL, NULL, NULL, NULL, 'Thỏa thuận', NULL, NULL, NULL, NULL FROM q WHERE NOT cut AND p_partkey % 97 = 0
UNION ALL SELECT DISTINCT crawl, page, 0, 'reply', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM q WHERE cut""")
def api_paged_replies(table):
    found = replies.postings(replies.records(_api_replies(table)))
    return found.select("crawl", "page", c("position").cast("long").alias("position"), "error", *_API)


@query(f"""WITH {_API_PAGES}, n AS (SELECT DISTINCT crawl FROM q WHERE NOT cut) SELECT crawl, page FROM n, (SELECT unnest(range(20)) AS page) EXCEPT SELECT crawl, page FROM q WHERE NOT cut""")
def api_lacking_pages(table):
    return replies.lacking(_api_replies(table), ["crawl"])


@query(f"""WITH {_API_PAGES}, r AS (SELECT * FROM q WHERE NOT cut AND p_partkey % 97 <> 0), s AS (SELECT crawl, min(page * 1000 + position) AS stop FROM r WHERE p_size = 7 GROUP BY crawl)
SELECT crawl, page, position, 'https://j/' || p_partkey AS job_url FROM r LEFT JOIN s USING (crawl) WHERE stop IS NULL OR page * 1000 + position < stop""")
def api_until_old(table):
    found = replies.postings(replies.records(_api_replies(table))).where("error is null")
    return replies.until(found, ["crawl"], c("experience") == "7").select("crawl", "page", c("position").cast("long").alias("position"), "job_url")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 = 0 AND CAST(o_orderdate AS DATE) = DATE '1995-01-10' UNION ALL SELECT -o_orderkey FROM orders WHERE o_orderkey % 3 = 0")
def staged_scan(table):
    orders = lineage.settled(table("orders").select("o_orderkey", c("o_orderdate").alias("scraped_at"), (c("o_orderkey") % 3 == 0).alias("ai_processed")), "staged")
    path = orders.inputFiles()[0].rsplit("/", 1)[0]
    return sources.staged(orders.sparkSession, path, "1995-01-10").select(c("o_orderkey").alias("id")).unionByName(sources.staged(orders.sparkSession, path).select((-c("o_orderkey")).alias("id")))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 2")
def url_category_filter(table):
    part = F.when(c("o_orderkey") % 3 == 0, "it-phan-mem").when(c("o_orderkey") % 3 == 1, "it-phan-cung-mang").otherwise("ke-toan")
    return sources.in_categories(table("orders").withColumn("url", F.concat(F.lit("https://x/"), part, F.lit("/"), "o_orderkey", F.lit(".html?from=/it-phan-mem/"))), "url").select("o_orderkey")


@query("SELECT page_id, NULL::VARCHAR AS none, 'Title ' || page_id || chr(10) || 'Why us' || chr(10) || repeat('word ', 12) || 'end ' || page_id AS block FROM pages")
def heading_block_climb(table):
    page = F.concat(F.lit("<h2>Why us</h2><section>Title "), "page_id", F.lit("<div><h3>Why us</h3></div><p>"), F.repeat(F.lit("word "), 12), F.lit("end "), "page_id", F.lit("</p></section>"))
    pages = table("pages").select("page_id", page.alias("html"))
    return sources.heading_blocks(pages, "WHY US").join(sources.heading_blocks(pages, "not there").withColumnRenamed("block", "none"), "page_id")


SITES = ("careerlink", "careerviet", "joboko", "timviec365", "vieclam24h")


@query("""SELECT 'https://job/' || page_id AS job_url, CASE page_id % 5 WHEN 0 THEN 'careerlink' WHEN 1 THEN 'careerviet' WHEN 2 THEN 'joboko' WHEN 3 THEN 'timviec365' ELSE 'vieclam24h' END AS website,
'Tester & ' || page_id AS job_title, CASE WHEN page_id % 5 = 1 AND page_id % 2 = 0 THEN NULL ELSE 'Company ' || page_id END AS company_title, 'City ' || (page_id % 7) AS location, (page_id % 9) || ' năm' AS experience, (page_id % 50) || ' triệu' AS compensation,
'Level ' || (page_id % 3) AS level, CASE WHEN page_id % 5 = 2 THEN NULL WHEN page_id % 5 IN (0) THEN 'IT / ' || url ELSE 'IT ' || url END AS company_industry, 'Build it ' || page_id || ' < all' AS job_description,
CASE page_id % 5 WHEN 1 THEN 'Company ' || page_id END AS company_page FROM pages""")
def site_fields(table):
    """Five sites' markup around the values, before the page's own."""
    n = c("page_id").cast("string")
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    title, company, place = say("Tester &amp; ", n), say("Company ", n), say("City ", (c("page_id") % 7).cast("string"))
    years, pay, level = say((c("page_id") % 9).cast("string"), " năm"), say((c("page_id") % 50).cast("string"), " triệu"), say("Level ", (c("page_id") % 3).cast("string"))
    url = F.replace("url", F.lit("&"), F.lit("&amp;"))
    text = say("<p>Build<br>it <!-- no --></p><ul><li>", n, "<li>&lt; all</ul>")
    pair = lambda tag, label, value: say(f"<section><{tag}>{label}</{tag}><{tag}>", value, f"</{tag}></section>")
    item = lambda label, value: say("<li><strong>", label, "</strong><p>", value, "</p>")
    bold = lambda label, value: say('<div class="item-content">', label, ': <span class="fw-bold">', value, "</span></div>")
    marked = lambda label, value: say("<div><div>", label, '</div><div class="text-14">', value, "</div></div>")
    markup = [
        say('<h1 class="job-title">', title, '</h1><div class="company-info"><b class="company-name-title"><a><span>', company, '</span></a></b></div><div id="job-location"><a title="', place, '">map</a></div><div id="job-salary"><span class="text-primary">', pay, "</span></div>",
            pair("div", "Kinh nghiệm", years), pair("div", "Cấp bậc", level), pair("div", "Ngành nghề", say("<span>IT</span>, <span>", url, "</span>")), '<div id="section-job-description"><div class="rich-text-content">', text, "</div></div>"),
        say('<div class="job-desc"><h1>', title, '</h1><a href="/c/', n, '">firm</a></div><div class="detail-box"><div class="map"><p><a>', place, "</a></p></div></div><ul>", item("Kinh nghiệm", years), item("Lương", pay), item("Cấp bậc", level), item("Ngành nghề", say("IT ", url)),
            "</ul><section><div><h2>Mô tả Công việc</h2><div>", text, "</div></div></section>"),
        say('<h1 class="nw-company-hero__title"><a>', title, '</a></h1><a class="nw-company-hero__text">', company, '</a><p class="nw-company-hero__address"><a>', place, "</a></p>", bold("Kinh nghiệm", years), bold("Thu nhập", pay), bold("Chức vụ", level), '<div class="text-left job-desc">', text, "</div>"),
        say('<div class="boxTitleNameNtd"><h1>', title, "</h1><a>", company, "</a></div>", pair("p", "Địa điểm", place), pair("p", "Kinh nghiệm", years), '<b class="valContentSalary txtSalaryNew">', pay, "</b>", pair("p", "Chức vụ", level),
            "<section><p>Ngành nghề</p><div><a>IT</a><a>", url, '</a></div></section><div class="itemInfoSpecific"><h2>Mô tả công việc</h2><div class="valInfoSpecific">', text, "</div></div>"),
        say("<h1>", title, '</h1><div class="flex flex-col gap-3"><a title="x"><div>', company, '</div></a><i class="svicon-users"></i></div>', marked("Khu vực tuyển", say("<a><span>", place, "</span></a>")), marked("Yêu cầu kinh nghiệm", years), marked("Mức lương", pay), marked("Cấp bậc", level),
            marked("Ngành nghề", say("<a>IT</a><a>", url, "</a>")), "<section><h2>Mô tả công việc</h2><div>", text, "</div></section>"),
    ]
    site, html = (F.element_at(F.array(*[F.lit(x) if isinstance(x, str) else x for x in xs]), (c("page_id") % 5 + 1).cast("int")) for xs in (SITES, markup))
    pages = table("pages").select("page_id", say("https://job/", n).alias("url"), site.alias("website"), F.concat(html, F.coalesce("html", F.lit(""))).alias("html"))
    firms = table("pages").where("page_id % 5 = 1").select("page_id", say("/c/", n).alias("url"), F.lit("careerviet").alias("website"), say('<div class="company-info"><h1>', company, "</h1></div>", F.coalesce("html", F.lit(""))).alias("html"))
    postings = lineage.settled(fields.fields_of(pages), "postings")
    values = lineage.settled(fields.company_values(firms), "companies")
    odd = F.substring_index("company_url", "/", -1).cast("long") % 2 == 1
    named = fields.with_company(postings, values.where(odd)).select("job_url", "company_title")
    company_page = fields.with_company(postings.where("website = 'careerviet'"), values).select("job_url", c("company_title").alias("company_page"))
    return postings.drop("company_title").join(named, "job_url").join(company_page, "job_url", "left").select("job_url", "website", "job_title", "company_title", "location", "experience", "compensation", "level", "company_industry", "job_description", "company_page")


@query(r"""SELECT page_id, regexp_replace(url, '[?#].*$', '') AS plain_url,
  CASE WHEN regexp_extract(regexp_replace(url, '[?#].*$', ''), '([0-9]+)(\.html?)?/?$', 1) <> '' THEN regexp_extract(regexp_replace(url, '[?#].*$', ''), '([0-9]+)(\.html?)?/?$', 1)
       WHEN regexp_extract(url, '[?&]page=([0-9]+)', 1) <> '' THEN regexp_extract(url, '[?&]page=([0-9]+)', 1) END AS url_id FROM pages""")
def url_normalise(table):
    return table("pages").select("page_id", t.url_without_query(c("url")).alias("plain_url"), t.url_id(c("url"), "page").alias("url_id"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1), '<[^>]*>', ' ', 'g'),
  '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\n\r]+', ' ', 'g'), ' ') AS title FROM pages""")
def html_title_extract(table):
    return sources.page_fields(table("pages")).select("page_id", "title")


@query(None)
def html_heading_block(table):
    return sources.page_fields(table("pages")).select("page_id", "heading", "block")


@query(r"""SELECT p_partkey, trim(regexp_replace(regexp_replace('<p>' || p_name || '</p><br>' || p_type, '<[^>]*>', ' ', 'g'), '[ \t\n\r]+', ' ', 'g'), ' ') AS plain FROM part""")
def html_strip(table):
    return table("part").select("p_partkey", t.without_tags(F.concat(F.lit("<p>"), "p_name", F.lit("</p><br>"), "p_type")).alias("plain"))


@query("""SELECT o.o_orderkey, CASE WHEN o.o_orderkey % 3 = 0 THEN 'detail' ELSE c.c_mktsegment END AS segment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def detail_else_card(table):
    details = table("orders").select("o_orderkey", c("o_custkey").alias("k"), F.when(c("o_orderkey") % 3 == 0, "detail").otherwise(" ").alias("segment"))
    cards = table("customer").select(c("c_custkey").alias("k"), c("c_mktsegment").alias("segment"))
    return sources.detail_else_card(details, cards, "k", ["segment"]).select("o_orderkey", "segment")


# Dimensions and sinks ---------------------------------------------------------------


@query("SELECT DISTINCT trim(c_mktsegment, ' ') AS segment FROM customer WHERE c_mktsegment IS NOT NULL AND trim(c_mktsegment, ' ') <> ''")
def dim_distinct_trim(table):
    return warehouse.distinct_trimmed(table("customer"), "c_mktsegment", "segment")


@query("""SELECT DISTINCT CASE WHEN p_size % 4 = 0 THEN 'Full-time' ELSE p_brand END AS kind, CASE WHEN p_size % 3 = 0 THEN 'Onsite' ELSE p_type END AS mode FROM part""")
def dim_pair_default(table):
    kind, mode = F.when(c("p_size") % 4 != 0, c("p_brand")).otherwise("  "), F.when(c("p_size") % 3 != 0, c("p_type"))
    return table("part").select(kind.alias("a"), mode.alias("b")).select(t.default_if_blank("a", "Full-time").alias("kind"), t.default_if_blank("b", "Onsite").alias("mode")).distinct()


@query("""WITH x AS (SELECT DISTINCT o_orderstatus AS l1, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS l2 FROM orders), old AS (SELECT * FROM x WHERE l1 <> 'F')
SELECT l1, l2, CAST(CASE WHEN l1 <> 'F' THEN 1 ELSE 2 END AS INTEGER) AS batch FROM x""")
def dim_nullable_pair(table):
    pairs = table("orders").select(c("o_orderstatus").alias("l1"), F.when(c("o_orderkey") % 2 == 0, c("o_orderpriority")).alias("l2")).distinct()
    return upsert.insert_ignore(pairs.where("l1 <> 'F'").withColumn("batch", F.lit(1)), pairs.withColumn("batch", F.lit(2)), ["l1", "l2"])


@query("SELECT n_name, CAST(n_regionkey AS INTEGER) AS n_regionkey FROM nation UNION ALL SELECT 'Unknown', -1")
def dim_default_row(table):
    nation = table("nation").select("n_name", "n_regionkey")
    row = {"n_name": "Unknown", "n_regionkey": -1}
    return upsert.default_row(upsert.default_row(nation, row), row)


@query("""SELECT CAST(c_nationkey AS INTEGER) AS nationkey, max(c_name) AS name, max(c_mktsegment) AS segment, max(c_acctbal) AS high, max(c_custkey) AS last FROM customer GROUP BY c_nationkey""")
def dim_group_max(table):
    return table("customer").groupBy(c("c_nationkey").alias("nationkey")).agg(F.max("c_name").alias("name"), F.max("c_mktsegment").alias("segment"), F.max("c_acctbal").alias("high"), F.max("c_custkey").alias("last"))


def _batches(table):
    orders = table("orders")
    old = orders.where("o_orderkey % 3 <> 0").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    new = orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("N").alias("o_orderstatus"), F.when(c("o_orderkey") % 4 == 0, F.upper("o_orderpriority")).alias("o_orderpriority"))
    return old, new


_BATCHES = """WITH old AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0),
new AS (SELECT o_orderkey, 'N' AS o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN upper(o_orderpriority) END AS o_orderpriority FROM orders WHERE o_orderkey % 2 = 0) """


@query(_BATCHES + "SELECT * FROM old UNION ALL SELECT * FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)")
def dim_insert_ignore(table):
    return upsert.insert_ignore(*_batches(table), ["o_orderkey"])


@query(_BATCHES + """SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, coalesce(o.o_orderstatus, n.o_orderstatus) AS o_orderstatus, coalesce(n.o_orderpriority, o.o_orderpriority) AS o_orderpriority
FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey""")
def dim_coalesce_upsert(table):
    return upsert.upsert(*_batches(table), ["o_orderkey"], {"o_orderpriority": "coalesce"})


@query(_BATCHES + """SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
CASE WHEN o.o_orderkey IS NULL THEN n.o_orderpriority ELSE o.o_orderpriority END AS o_orderpriority,
CASE WHEN o.o_orderkey IS NULL THEN 'new' WHEN n.o_orderkey IS NULL THEN 'kept' ELSE 'updated' END AS upsert_status FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey""")
def fact_upsert_update_list(table):
    return upsert.upsert(*_batches(table), ["o_orderkey"], {"o_orderstatus": "replace"}, with_status=True)


@query(_BATCHES + """SELECT count(*) FILTER (WHERE o.o_orderkey IS NULL) AS new_rows, count(*) FILTER (WHERE o.o_orderkey IS NOT NULL AND n.o_orderkey IS NOT NULL) AS updated_rows FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey""")
def upsert_counts(table):
    return upsert.status_counts(upsert.upsert(*_batches(table), ["o_orderkey"], {}, with_status=True))


@query("""SELECT CAST(row_number() OVER (ORDER BY p_brand) AS INTEGER) AS brand_id, p_brand FROM (SELECT DISTINCT p_brand FROM part)""")
def dim_surrogates(table):
    brands = table("part").select("p_brand").distinct()
    old = brands.where("false").select(F.lit(0).alias("brand_id"), "p_brand")
    return upsert.with_surrogates(old, upsert.insert_ignore(old, brands, ["p_brand"]), "brand_id", ["p_brand"])


@query("""SELECT o_orderkey, o_orderpriority, o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders""")
def numbered_at_scale(table):
    return upsert.with_numbers(table("orders"), "n", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_orderpriority", "o_custkey", "n")


@query("""SELECT o_orderkey, o_orderkey % 10 = 0 AS is_duplicate, CASE WHEN o_orderkey % 10 = 0 THEN o_custkey END AS duplicate_of_id, CASE WHEN o_orderkey % 10 = 0 THEN 'exact' END AS dedup_method FROM orders""")
def flags_reset_and_update(table):
    rows = upsert.without_flags(table("orders").select("o_orderkey", "o_custkey", F.lit(True).alias("is_duplicate"), c("o_orderkey").alias("duplicate_of_id"), F.lit("old").alias("dedup_method")))
    flags = rows.where("o_orderkey % 10 = 0").select("o_orderkey", F.lit(True).alias("is_duplicate"), c("o_custkey").alias("duplicate_of_id"), F.lit("exact").alias("dedup_method"))
    return upsert.with_flags(rows, flags, "o_orderkey").drop("o_custkey")


# Windows and joins -------------------------------------------------------------------


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1")
def rownum_latest(table):
    return windows.latest(table("events"), ["user_id"], F.desc_nulls_last("ts"), "event_id").select("user_id", "event_id", "event_type")


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn <= 5")
def first_k_per_group(table):
    return windows.first_k(table("events"), ["event_type"], 5, F.desc("value"), "event_id").select("event_type", "event_id")


@query("""SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def fact_star_join(table):
    return (table("orders").join(table("customer"), c("o_custkey") == c("c_custkey"), "left").join(table("nation"), c("c_nationkey") == c("n_nationkey"), "left")
            .join(table("region"), c("n_regionkey") == c("r_regionkey"), "left").select("o_orderkey", "c_name", "n_name", "r_name"))


@query("""SELECT s_suppkey, coalesce(n.n_nationkey, f.n_nationkey) AS nationkey FROM supplier LEFT JOIN nation n ON n.n_nationkey = CASE WHEN s_suppkey % 4 <> 0 THEN s_nationkey END
LEFT JOIN nation f ON f.n_nationkey = (SELECT min(n_nationkey) FROM nation)""")
def fallback_join(table):
    nation = table("nation").select("n_nationkey")
    other = nation.agg(F.min("n_nationkey").alias("other"))
    rows = table("supplier").withColumn("k", F.when(c("s_suppkey") % 4 != 0, c("s_nationkey")))
    return rows.join(nation, c("k") == c("n_nationkey"), "left").crossJoin(F.broadcast(other)).select("s_suppkey", F.coalesce("n_nationkey", "other").alias("nationkey"))  # one row


@query("""WITH x AS (SELECT DISTINCT o_orderstatus AS s, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS q FROM orders)
SELECT o.o_orderkey, x.s, x.q FROM orders o LEFT JOIN x ON o.o_orderstatus = x.s AND (CASE WHEN o.o_orderkey % 2 = 0 THEN o.o_orderpriority END) IS NOT DISTINCT FROM x.q""")
def nullsafe_join(table):
    orders = table("orders").withColumn("k", F.when(c("o_orderkey") % 2 == 0, c("o_orderpriority")))
    dim = orders.select(c("o_orderstatus").alias("s"), c("k").alias("q")).distinct()
    return orders.join(dim, (c("o_orderstatus") == c("s")) & c("k").eqNullSafe(c("q")), "left").select("o_orderkey", "s", "q")


@query("""SELECT l.l_orderkey, l.l_linenumber, p.p_brand FROM lineitem l JOIN (SELECT p_partkey, p_size % 7 AS z, p_brand FROM part) p ON l.l_partkey = p.p_partkey AND l.l_linenumber = p.z""")
def composite_join(table):
    part = table("part").select("p_partkey", (c("p_size") % 7).alias("z"), "p_brand")
    return table("lineitem").join(part, (c("l_partkey") == c("p_partkey")) & (c("l_linenumber") == c("z"))).select("l_orderkey", "l_linenumber", "p_brand")


_SALARY = """SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN CAST(p_size * 10 AS DECIMAL(18,0)) END AS lo, CASE WHEN p_size % 7 <> 0 THEN CAST(p_size * 13 AS DECIMAL(18,0)) END AS hi FROM part"""


@query(f"""SELECT p_partkey, CAST(CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN round((lo + hi) / CAST(2 AS DECIMAL(2,0)), 0) WHEN lo IS NOT NULL THEN lo ELSE hi END AS DECIMAL(18,0)) AS average FROM ({_SALARY})""")
def salary_avg_case(table):
    return table("part").select("p_partkey", warehouse.salary_average(F.when(c("p_size") % 5 != 0, c("p_size") * 10), F.when(c("p_size") % 7 != 0, c("p_size") * 13)).alias("average"))


@query("""SELECT p_partkey, coalesce(CASE WHEN p_size % 3 = 0 THEN 'yearly' END, CASE WHEN (p_size % 2 = 0) = FALSE THEN 'monthly' ELSE 'negotiable' END) AS kind FROM part""")
def type_coalesce_case(table):
    return table("part").select("p_partkey", warehouse.salary_kind(F.when(c("p_size") % 3 == 0, "yearly"), c("p_size") % 2 == 0).alias("kind"))


@query("""SELECT p_partkey, trim(v, ' ') AS word FROM (SELECT p_partkey, unnest(string_split(replace(p_name, ' ', ' , ') || ',', ',')) AS v FROM part) WHERE trim(v, ' ') <> ''""")
def multivalue_unnest(table):
    values = F.split(F.concat(F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(",")), ",")
    return table("part").select("p_partkey", F.explode(values).alias("v")).select("p_partkey", F.trim("v").alias("word")).where("word <> ''")


_REQUIREMENTS = """WITH r AS (SELECT p_partkey AS etl_id, 'hard_skill' AS require_type, unnest(string_split(replace(p_name, ' ', ','), ',')) AS v FROM part UNION ALL SELECT p_partkey, 'major', p_brand FROM part
UNION ALL SELECT p_partkey, 'language', CASE WHEN p_size % 2 = 0 THEN p_type END FROM part), q AS (SELECT DISTINCT etl_id, require_type, trim(v, ' ') AS require_value FROM r WHERE trim(v, ' ') <> '') """


def _requirements(table):
    rows = table("part").select(c("p_partkey").alias("etl_id"), F.replace("p_name", F.lit(" "), F.lit(",")).alias("hard_skills"), F.lit(None).cast("string").alias("soft_skills"), F.lit("").alias("certifications"), F.when(c("p_size") % 2 == 0, c("p_type")).alias("languages"), c("p_brand").alias("major"))
    return warehouse.requirements(rows)


@query(_REQUIREMENTS + "SELECT DISTINCT require_type, require_value FROM q")
def require_dim_union(table):
    return _requirements(table).select("require_type", "require_value").distinct()


@query(_REQUIREMENTS + ", dim AS (SELECT row_number() OVER (ORDER BY require_type, require_value) AS require_id, * FROM (SELECT DISTINCT require_type, require_value FROM q)) SELECT DISTINCT etl_id, require_id FROM q JOIN dim USING (require_type, require_value)")
def bridge_join(table):
    rows = _requirements(table)
    dim = rows.select("require_type", "require_value").distinct().withColumn("require_id", F.row_number().over(Window.orderBy("require_type", "require_value")).cast("long"))
    return rows.join(dim, ["require_type", "require_value"]).select("etl_id", "require_id").distinct()


@query("SELECT 'all' AS mode, count(*) AS n FROM events WHERE event_type <> 'error' UNION ALL SELECT 'today', count(*) FROM events WHERE event_type <> 'error' AND CAST(CAST(ts AS DATE) AS VARCHAR) = '2024-01-15'")
def mode_today_vs_all(table):
    rows = table("events").select((c("event_type") != "error").alias("is_valid"), F.to_date("ts").alias("etl_run_id"))
    return warehouse.of_run(rows, "all", None).agg(F.lit("all").alias("mode"), F.count("*").alias("n")).unionByName(warehouse.of_run(rows, "today", "2024-01-15").agg(F.lit("today").alias("mode"), F.count("*").alias("n")))


_STATUS = "CASE event_type WHEN 'view' THEN 'new' WHEN 'click' THEN 'updated' WHEN 'signup' THEN 'duplicate' WHEN 'purchase' THEN 'invalid' ELSE 'error' END"


@query(f"""SELECT *, CASE WHEN error_jobs > 0 THEN 'FAILED' WHEN invalid_jobs > 0.2 * total_scraped THEN 'WARN' ELSE 'SUCCESS' END AS status FROM (
SELECT user_id, count(*) AS total_scraped, count(*) FILTER (WHERE s = 'new') AS new_jobs, count(*) FILTER (WHERE s = 'updated') AS updated_jobs, count(*) FILTER (WHERE s = 'duplicate') AS duplicate_jobs,
count(*) FILTER (WHERE s = 'invalid') AS invalid_jobs, count(*) FILTER (WHERE s = 'error') AS error_jobs FROM (SELECT user_id, {_STATUS} AS s FROM events) GROUP BY user_id)""")
def crawl_counters(table):
    return ingest.snapshot(table("events").select("user_id", F.expr(_STATUS).alias("status")), ("user_id",))


@query("""SELECT user_id, CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0.2 * count(*) THEN 'WARN' ELSE 'SUCCESS' END AS status, CAST(floor(epoch(max(ts))) AS BIGINT) - CAST(floor(epoch(min(ts))) AS BIGINT) AS seconds FROM events GROUP BY user_id""")
def run_status_ratio(table):
    rows = table("events").withColumn("at", F.unix_timestamp(F.date_trunc("second", c("ts").cast("timestamp"))))
    status = F.when(F.count_if(c("event_type") == "error") > 0.2 * F.count("*"), "WARN").otherwise("SUCCESS")
    return rows.groupBy("user_id").agg(status.alias("status"), (F.max("at") - F.min("at")).alias("seconds"))


@query("SELECT max(event_id) AS last_run FROM events")
def max_run_id(table):
    return table("events").agg(F.max("event_id").alias("last_run"))


# Duplicates ------------------------------------------------------------------------------

_CHAINS = """WITH e AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events), f AS (SELECT *, CASE WHEN s - lag(s) OVER w > 21600 OR lag(s) OVER w IS NULL THEN 1 ELSE 0 END AS brk FROM e WINDOW w AS (PARTITION BY user_id, event_type ORDER BY s, event_id)),
g AS (SELECT *, sum(brk) OVER (PARTITION BY user_id, event_type ORDER BY s, event_id ROWS UNBOUNDED PRECEDING) AS chain FROM f), h AS (SELECT *, first_value(event_id) OVER (PARTITION BY user_id, event_type, chain ORDER BY s, event_id) AS root FROM g) """


def _chained(table):
    rows = table("events").withColumn("s", F.unix_timestamp(F.date_trunc("second", c("ts").cast("timestamp"))))
    return windows.gap_chains(rows, ["user_id", "event_type"], c("s"), 21600, "event_id", "s", "event_id")


@query(_CHAINS + "SELECT event_id AS dup_id, root AS canon_id FROM h WHERE event_id <> root")
def dedup_exact_gap(table):
    return _chained(table).where("event_id <> root").select(c("event_id").alias("dup_id"), c("root").alias("canon_id"))


@query(_CHAINS + "SELECT event_id, user_id, event_type FROM h WHERE event_id = root")
def dedup_unique_view(table):
    return _chained(table).where("event_id = root").select("event_id", "user_id", "event_type")


def _title_postings(table) -> DataFrame:
    docs = table("documents")
    return docs.select(
        c("doc_id").alias("etl_id"), F.lit(1).alias("etl_run_id"), F.lit("site").alias("website_clean"), F.concat_ws("-", "lang", "source").alias("company_title_clean"), F.concat_ws("-", "lang", "source").alias("company_canonical_key"), c("lang").alias("location_province"),
        F.split("text", "\n", 2)[0].alias("job_title_clean"), F.lit("").alias("level_clean"), F.lit(None).cast("double").alias("salary_min"), F.lit(None).cast("double").alias("salary_max"),
        F.date_add(F.lit("2026-01-01").cast("date"), (c("doc_id") % 90).cast("int")).alias("job_posted_at_clean"), F.lit(True).alias("is_valid"))


@query(None)
def dedup_fuzzy_title(table):
    return linkage.full(_title_postings(table), 45)


_TWO_LOADS = """WITH a AS (SELECT o_custkey AS custkey, o_orderstatus = 'F' AS done, min(o_orderkey) AS first_order, max(o_orderkey) AS last_order, max(CASE WHEN o_totalprice > 200000 THEN o_orderkey END) AS dear_order FROM orders
WHERE o_orderstatus IS NOT NULL GROUP BY 1, 2), f AS (SELECT * FROM a WHERE done), n AS (SELECT * FROM a WHERE NOT done) """


def _two_loads(table) -> versioned.Bucketed:
    """Each customer's orders, done ones first, loaded into a new table: the first is kept, the last replaced, the dear one replaced unless there is none."""
    orders = table("orders")
    spark = orders.sparkSession
    schema = schemas.columns("custkey long, first_order long, last_order long, dear_order long")
    store = versioned.Bucketed(lineage.fresh_path(spark, "customers"), schema, ("custkey",), buckets=64).create(spark)
    for done in (c("o_orderstatus") == "F", c("o_orderstatus") != "F"):
        store.load(orders.where(done).groupBy(c("o_custkey").alias("custkey")).agg(
            F.min("o_orderkey").alias("first_order"), F.max("o_orderkey").alias("last_order"), F.max(F.when(c("o_totalprice") > 200000, c("o_orderkey"))).alias("dear_order")), {"last_order": "replace", "dear_order": "coalesce"})
    return store


@query(_TWO_LOADS + """SELECT coalesce(f.custkey, n.custkey) AS custkey, coalesce(f.first_order, n.first_order) AS first_order, coalesce(n.last_order, f.last_order) AS last_order, coalesce(n.dear_order, f.dear_order) AS dear_order
FROM f FULL JOIN n ON f.custkey = n.custkey""")
def bucketed_upsert(table):
    store = _two_loads(table)
    return store.read(table("orders").sparkSession)


@query(_TWO_LOADS + """SELECT 1 AS version, count(*) AS new_rows, 0 AS updated_rows FROM f
UNION ALL SELECT 2, count(*) FILTER (WHERE f.custkey IS NULL), count(*) FILTER (WHERE f.custkey IS NOT NULL) FROM n LEFT JOIN f ON n.custkey = f.custkey""")
def load_counts_observed(table):
    store = _two_loads(table)
    return store.history(table("orders").sparkSession).select("version", "new_rows", "updated_rows")


@query("""WITH r AS (SELECT o_orderkey AS id, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS d, lag(CAST(o_orderdate AS DATE)) OVER w AS before FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL AND o_orderdate IS NOT NULL
WINDOW w AS (PARTITION BY o_custkey, o_orderpriority ORDER BY CAST(o_orderdate AS DATE), o_orderkey)),
k AS (SELECT *, sum(CASE WHEN before IS NULL OR d - before > 180 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY d, id ROWS UNBOUNDED PRECEDING) AS chain FROM r),
h AS (SELECT id, first_value(id) OVER (PARTITION BY o_custkey, o_orderpriority, chain ORDER BY d, id) AS root FROM k) SELECT id AS dup_id, root AS canon_id FROM h WHERE id <> root""")
def linkage_state_exact(table):
    """Orders of one customer and priority as copies, taken in three runs by date through a state of live chains."""
    orders = table("orders")
    spark = orders.sparkSession
    rows = orders.where("o_custkey is not null and o_orderpriority is not null and o_orderdate is not null").select(
        c("o_orderkey").alias("etl_id"), F.concat(F.lit("c"), c("o_custkey")).alias("co"), F.lit("p").alias("prov"), c("o_orderpriority").alias("title"), F.lit("").alias("lvl"), F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01")).alias("day"), F.lit(1).alias("rank"), F.lit(0).alias("info"))
    state = linkage_state.state_at(lineage.fresh_path(spark, "live-chains"), 16).create(spark)
    links = []
    for low, high in ((-100000, 8766), (8766, 9862), (9862, 100000)):  # until 1994, until 1997, since
        links.append(linkage_state.take_exact(spark, state, rows.where((c("day") >= low) & (c("day") < high)), high - 1, 180))
    return functools.reduce(DataFrame.unionByName, links)


@query(None)
def dedup_daily_state(table):
    """The postings of dedup_fuzzy_title in three runs of thirty days."""
    rows = _title_postings(table)
    spark = rows.sparkSession
    state = linkage_state.state_at(lineage.fresh_path(spark, "live-chains"), 64).create(spark)
    runs = []
    for first, last in (("2026-01-01", "2026-01-30"), ("2026-01-31", "2026-03-01"), ("2026-03-02", "2026-03-31")):
        runs.append(linkage_state.run(spark, state, rows.where(c("job_posted_at_clean").between(first, last)), last, 45))
    return functools.reduce(DataFrame.unionByName, runs)


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL '2 hours' OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS brk FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, brk DESC ROWS UNBOUNDED PRECEDING) AS s FROM e) SELECT user_id, count(*) AS n FROM g GROUP BY user_id, s""")
def session_gap_window(table):
    return incremental.sessions(table("events").withColumn("at", c("ts").cast("timestamp")), ["user_id"], "at", "2 hours").select("user_id", "n")


# Parsers -----------------------------------------------------------------------------------

_D = "CAST(o_orderdate AS DATE)"


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE {_D} END AS day FROM orders""")
def parse_date_multi(table):
    day = F.to_date("o_orderdate")
    text = F.when(c("o_orderkey") % 4 == 0, F.date_format(day, "dd/MM/yyyy")).when(c("o_orderkey") % 4 == 1, F.date_format(day, "yyyy-MM-dd")).when(c("o_orderkey") % 4 == 2, F.concat(F.lit("(new) "), F.date_format(day, "d-M-yyyy"))).otherwise("31/02/2020")
    return table("orders").select("o_orderkey", p.date_of(text, F.lit("2020-01-01")).alias("day"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN DATE '2024-03-01' - CAST(user_id % 50 AS INTEGER) WHEN 1 THEN DATE '2024-03-01' - CAST(7 * (user_id % 50) AS INTEGER) WHEN 2 THEN DATE '2024-03-01' + CAST(user_id % 50 AS INTEGER)
ELSE DATE '2024-03-01' - CAST(30 * (user_id % 50) AS INTEGER) END AS day FROM events""")
def relative_date(table):
    n = (c("user_id") % 50).cast("string")
    text = F.when(c("event_id") % 4 == 0, F.concat(n, F.lit(" days ago"))).when(c("event_id") % 4 == 1, F.concat(n, F.lit(" tuần trước"))).when(c("event_id") % 4 == 2, F.concat(F.lit("Còn "), n, F.lit(" ngày"))).otherwise(F.concat(n, F.lit(" months ago")))
    return table("events").select("event_id", p.date_of(text, F.lit("2024-03-01T12:00:00")).alias("day"))


@query("SELECT event_id, user_id % 9 > 3 AS old FROM events")
def age_filter(table):
    return table("events").select("event_id", p.is_old(F.concat((c("user_id") % 9).cast("string"), F.lit(" ngày trước")), F.lit("2024-03-01T12:00:00"), 3).alias("old"))


@query("""WITH cards AS (SELECT event_id, user_id, event_type, max(CASE WHEN event_id * 7 % 40 > 30 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS seen FROM events)
SELECT event_id, user_id, event_type FROM cards WHERE seen = 0""")
def stop_at_first_old(table):
    cards = table("events").withColumn("posted", F.concat((c("event_id") * 7 % 40).cast("string"), F.lit(" ngày trước")))
    return windows.take_while(cards, ["user_id", "event_type"], p.is_old(c("posted"), F.lit("2024-03-01T12:00:00"), 30), "ts", "event_id").select("event_id", "user_id", "event_type")


@query("""WITH s AS (SELECT 'u' || p_partkey AS job_url, p_name AS job_title, p_brand AS compensation, p_type AS website FROM part),
o AS (SELECT job_url, job_title, compensation, website FROM s, part p WHERE s.job_url = 'u' || p.p_partkey AND p_partkey % 3 <> 0), n AS (SELECT job_url, upper(job_title) AS job_title, website FROM s, part p WHERE s.job_url = 'u' || p.p_partkey AND p_partkey % 2 = 0 AND p_size > 5)
SELECT coalesce(o.job_url, n.job_url) AS job_url, CASE WHEN n.job_url IS NULL THEN o.job_title ELSE n.job_title END AS job_title, CASE WHEN n.job_url IS NULL THEN o.compensation END AS compensation, CASE WHEN o.job_url IS NULL THEN n.website ELSE o.website END AS website,
CASE WHEN o.job_url IS NULL THEN 'new' WHEN n.job_url IS NULL THEN 'kept' ELSE 'updated' END AS upsert_status FROM o FULL JOIN n ON o.job_url = n.job_url""")
def staging_upsert(table):
    rows = table("part").withColumns({"job_url": F.concat(F.lit("u"), "p_partkey"), "job_title": c("p_name"), "compensation": c("p_brand"), "website": c("p_type")})
    old = rows.where("p_partkey % 3 <> 0").select("job_url", "job_title", "compensation", "website")
    new = rows.where("p_partkey % 2 = 0").select("job_url", F.upper("job_title").alias("job_title"), "website", (c("p_size") > 5).alias("is_valid"))
    return ingest.staged(old, new)


@query("""WITH r AS (SELECT 'u' || o_custkey AS job_url, o_orderpriority AS location_province, o_orderstatus AS level_clean, o_orderdate, o_orderkey FROM orders),
l AS (SELECT *, row_number() OVER (PARTITION BY job_url, location_province ORDER BY CAST(o_orderdate AS DATE) DESC, level_clean, o_orderkey) AS k FROM r WHERE o_orderkey % 2 = 0), n AS (SELECT * FROM l WHERE k = 1),
f AS (SELECT *, row_number() OVER (PARTITION BY job_url, location_province ORDER BY o_orderkey) AS k FROM r WHERE o_orderkey % 2 = 1), o AS (SELECT * FROM f WHERE k = 1)
SELECT coalesce(o.job_url, n.job_url) AS job_url, coalesce(o.location_province, n.location_province) AS location_province, coalesce(n.level_clean, o.level_clean) AS level_clean, coalesce(o.o_orderkey, n.o_orderkey) AS src_id,
CASE WHEN o.job_url IS NULL THEN 'new' WHEN n.job_url IS NULL THEN 'kept' ELSE 'updated' END AS upsert_status FROM o FULL JOIN n ON o.job_url = n.job_url AND o.location_province = n.location_province""")
def cleaned_upsert(table):
    rows = table("orders").select(F.concat(F.lit("u"), "o_custkey").alias("job_url"), c("o_orderpriority").alias("location_province"), c("o_orderstatus").alias("level_clean"), c("o_orderkey").alias("src_id"), F.to_date("o_orderdate").alias("scraped_at"))
    old = windows.latest(rows.where("src_id % 2 = 1"), ["job_url", "location_province"], "src_id").drop("scraped_at")
    return transform.loaded(old, rows.where("src_id % 2 = 0"))


@query(f"SELECT o_orderkey, strftime({_D}, '%d/%m/%Y') AS written FROM orders")
def date_clean_day_first(table):
    return table("orders").select("o_orderkey", p.day_first(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00"))).alias("written"))


@query("""SELECT p_partkey, p_name || ' engineer -' AS title FROM part""")
def title_noise_clean(table):
    return table("part").select("p_partkey", p.title_clean(F.concat(F.lit("[HN]  "), "p_name", F.lit("  engineer - (Remote)"))).alias("title"))


def _quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def _list_of(words) -> str:
    return "[" + ", ".join(map(_quoted, words)) + "]"


#: Sides of a keyword in SQL: nothing, no letter a-z or digit, no character of a word.
_INSIDE, _ALONE, _WORD = ("", ""), ("(^|[^a-z0-9])", "($|[^a-z0-9])"), (r"(^|[^\p{L}\p{M}\p{N}_])", r"($|[^\p{L}\p{M}\p{N}_])")


def _found(text: str, words, sides) -> str:
    """SQL that tells whether any of the words is in the text between such sides."""
    return f"regexp_matches({text}, {_quoted(sides[0] + '(' + '|'.join(re.escape(w) for w in words) + ')' + sides[1])})"


def _first(text: str, groups, sides, default: str = "NULL") -> str:
    """SQL of the first group's label, one condition after the other."""
    return f"CASE {' '.join(f'WHEN {_found(text, words, sides)} THEN {_quoted(label)}' for label, words in groups)} ELSE {default} END"


def _all(text: str, groups, sides) -> str:
    """SQL of the sorted labels of all groups, joined; null without any."""
    return f"nullif(concat_ws(', ', {', '.join(f'CASE WHEN {_found(text, words, sides)} THEN {_quoted(label)} END' for label, words in sorted(groups))}), '')"


_VOCABULARY = d.Vocabulary()
_TITLE_WORDS = [w for groups in (d.TITLES, d.OTHER_TITLES) for _, words in groups for w in words] + ["react programmer", "spark analysis", "clerk"]
_PAIR = "CASE " + " ".join(f"WHEN role = '{role}' AND domain = '{domain}' THEN {_quoted(label)}" for (role, domain), label in d.ROLE_DOMAIN_TITLES.items()) + " END"


@query(f"""WITH t AS (SELECT p_partkey, lower(CASE p_partkey % 3 WHEN 0 THEN 'Senior ' WHEN 1 THEN '(x)' ELSE '' END || ({_list_of(_TITLE_WORDS)})[1 + p_partkey % {len(_TITLE_WORDS)}] || CASE p_partkey % 4 WHEN 0 THEN '/' WHEN 1 THEN ' ' WHEN 2 THEN '9' ELSE ', ' END || ({_list_of(_TITLE_WORDS)})[1 + p_partkey * 7 % {len(_TITLE_WORDS)}]) AS title FROM part),
f AS (SELECT *, {_first("title", d.ROLES, _INSIDE)} AS role, {_first("title", d.DOMAINS, _INSIDE)} AS domain FROM t)
SELECT p_partkey, title, coalesce({_first("title", d.TITLES, _ALONE)}, {_PAIR}, {_first("title", d.OTHER_TITLES, _ALONE)}) AS label FROM f""")
def title_first_match(table):
    n, words = len(_TITLE_WORDS), keywords.constant(_TITLE_WORDS, "array<string>")
    word = lambda i: F.get(words, (i % n).cast("int"))
    lead = F.when(c("p_partkey") % 3 == 0, "Senior ").when(c("p_partkey") % 3 == 1, "(x)").otherwise("")
    glue = F.when(c("p_partkey") % 4 == 0, "/").when(c("p_partkey") % 4 == 1, " ").when(c("p_partkey") % 4 == 2, "9").otherwise(", ")
    rows = table("part").select("p_partkey", F.lower(F.concat(lead, word(c("p_partkey")), glue, word(c("p_partkey") * 7))).alias("title"))
    return rows.select("p_partkey", "title", p.title_detected(c("title"), _VOCABULARY).alias("label"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Front-end Developer' WHEN p_size % 3 = 1 THEN 'Data Analyst' END AS label, CASE WHEN p_size % 3 = 0 THEN 'Software Development' WHEN p_size % 3 = 1 THEN 'Data Analytics' ELSE 'Non-IT' END AS category, p_size % 3 <> 2 AS is_it FROM part""")
def title_role_domain(table):
    title = F.when(c("p_size") % 3 == 0, "React programmer").when(c("p_size") % 3 == 1, "spark analysis").otherwise("clerk")
    rows = p.with_title(table("part").select("p_partkey", "p_size", title.alias("job_title")))
    return rows.select("p_partkey", c("job_title_detect").alias("label"), c("job_category_clean").alias("category"), "is_it")


@query("""SELECT c_custkey, 'CÔNG TY CỔ PHẦN ' || upper(c_name) AS company, 'Cổ phần' AS kind, trim(regexp_replace('cong ty ' || regexp_replace(lower(c_name), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'), ' ') AS key FROM customer""")
def company_canonical(table):
    made = p.company(F.concat(F.lit("CTCP "), "c_name"))
    return table("customer").select("c_custkey", made["company_title_clean"].alias("company"), made["company_type"].alias("kind"), made["company_canonical_key"].alias("key"))


@query("""SELECT n_nationkey, v AS province, CASE v WHEN 'TP. Hà Nội' THEN 'Bắc' WHEN 'TP. Hồ Chí Minh' THEN 'Nam' ELSE 'Khác' END AS region FROM (SELECT n_nationkey, unnest(CASE WHEN n_nationkey % 3 = 0 THEN ['TP. Hà Nội', 'TP. Hồ Chí Minh'] WHEN n_nationkey % 3 = 1 THEN ['Khác'] ELSE ['TP. Hà Nội'] END) AS v FROM nation)""")
def location_fanout(table):
    place = F.when(c("n_nationkey") % 3 == 0, "Ha Noi, HCM; hanoi").when(c("n_nationkey") % 3 == 1, "").otherwise("Hanoi city, Viet Nam")
    return p.fanned_out(p.with_places(table("nation").select("n_nationkey", place.alias("location")))).select("n_nationkey", c("location_province").alias("province"), c("location_region").alias("region"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Part-time' WHEN 1 THEN 'Freelance' ELSE 'Full-time' END AS kind, CASE o_orderkey % 3 WHEN 0 THEN 'Remote' WHEN 1 THEN 'Hybrid' ELSE 'Onsite' END AS mode FROM orders""")
def work_style(table):
    kind = F.when(c("o_orderkey") % 4 == 0, "internship").when(c("o_orderkey") % 4 == 1, "CTV").otherwise("")
    mode = F.when(c("o_orderkey") % 3 == 0, "WFH").when(c("o_orderkey") % 3 == 1, "flexible")
    made = p.work_style(kind, mode, F.lit(""))
    return table("orders").select("o_orderkey", made["job_type_clean"].alias("kind"), made["work_mode_clean"].alias("mode"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Công nghệ' WHEN p_size % 3 = 1 THEN 'Tài chính và Kinh doanh' ELSE 'Không xác định' END AS l1, CASE WHEN p_size % 3 = 0 THEN 'Phát triển phần mềm và Ứng dụng' WHEN p_size % 3 = 1 THEN 'Kế toán và Kiểm toán' ELSE 'Không xác định' END AS l2 FROM part""")
def industry_first_match(table):
    made = p.industry(F.when(c("p_size") % 3 == 0, "SaaS, sql").when(c("p_size") % 3 == 1, "audit").otherwise(""), F.lit(None))
    return table("part").select("p_partkey", made["industry_level1"].alias("l1"), made["industry_level2"].alias("l2"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Thạc sĩ' WHEN p_size % 3 = 1 THEN 'Đại học' ELSE 'Không yêu cầu' END AS education FROM part""")
def education_first_source(table):
    return table("part").select("p_partkey", p.education(F.when(c("p_size") % 3 == 0, "Master or bachelor"), F.when(c("p_size") % 3 == 1, "a PhD"), F.when(c("p_size") % 3 == 1, "Bachelor")).alias("education"))


@query("""SELECT p_partkey, CAST(p_size * 1000000 AS BIGINT) AS salary_min, CAST(p_size * 1000000 + 5000000 AS BIGINT) AS salary_max, 'VND' AS salary_currency, 'monthly' AS salary_type FROM part""")
def salary_parse_range(table):
    text = F.concat(c("p_size").cast("string"), F.lit(" - "), (c("p_size") + 5).cast("string"), F.lit(" triệu"))
    return p.with_salary(table("part").select("p_partkey", text.alias("compensation"))).select("p_partkey", "salary_min", "salary_max", "salary_currency", "salary_type")


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'USD' WHEN p_size % 4 = 1 THEN 'EUR' WHEN p_size % 4 = 2 THEN 'JPY' ELSE 'VND' END AS currency FROM part""")
def salary_currency(table):
    text = F.when(c("p_size") % 4 == 0, "2k").when(c("p_size") % 4 == 1, "900 EUR").when(c("p_size") % 4 == 2, "90000 jpy").otherwise("20 tr")
    return table("part").select("p_partkey", p.currency_of(text).alias("currency"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(p_size * 100 AS BIGINT) WHEN p_size % 3 = 1 THEN CAST(3200 + p_size * 160 AS BIGINT) ELSE CAST(1000 + p_size AS BIGINT) END AS monthly, CASE WHEN p_size % 3 = 0 THEN 'yearly' WHEN p_size % 3 = 1 THEN 'hourly' ELSE 'monthly' END AS salary_type FROM part""")
def salary_period(table):
    n = lambda x: x.cast("string")
    text = F.when(c("p_size") % 3 == 0, F.concat(F.lit("$"), n(c("p_size") * 1200), F.lit("/year"))).when(c("p_size") % 3 == 1, F.concat(F.lit("$"), n(c("p_size") + 20), F.lit("/hour"))).otherwise(F.concat(F.lit("$"), n(c("p_size") + 1000)))
    return p.with_salary(table("part").select("p_partkey", text.alias("compensation"))).select("p_partkey", c("salary_min").alias("monthly"), "salary_type")


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 0.0 WHEN p_size % 4 = 3 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS lo, CASE WHEN p_size % 4 = 0 THEN 0.0 WHEN p_size % 4 = 1 THEN CAST(p_size + 2 AS DOUBLE) END AS hi, CASE WHEN p_size % 4 = 3 THEN NULL ELSE p_size % 4 <> 0 END AS required FROM part""")
def experience_parse(table):
    size = c("p_size").cast("string")
    text = F.when(c("p_size") % 4 == 0, "Không yêu cầu").when(c("p_size") % 4 == 1, F.concat(size, F.lit("-"), (c("p_size") + 2).cast("string"), F.lit(" năm"))).when(c("p_size") % 4 == 2, F.concat(F.lit("Trên "), size, F.lit(" năm")))
    rows = p.with_experience(table("part").select("p_partkey", text.alias("experience"), F.lit("").alias("job_description"), F.lit("Hello.").alias("job_requirement")))
    return rows.select("p_partkey", c("exp_min_yr").alias("lo"), c("exp_max_yr").alias("hi"), c("is_exp_required").alias("required"))


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'Senior' WHEN p_size < 3 THEN CASE WHEN p_size < 1.5 THEN 'Fresher' ELSE 'Junior' END WHEN p_size < 5 THEN 'Middle' WHEN p_size < 8 THEN 'Senior' WHEN p_size < 12 THEN 'Lead' ELSE 'Manager+' END AS level FROM part""")
def level_bucket(table):
    years = c("p_size").cast("double")
    return table("part").select("p_partkey", p.level(F.lit(""), F.when(c("p_size") % 5 == 0, "Senior clerk"), years, years, F.lit(""), F.lit("")).alias("level"))


@query(f"""WITH f AS (SELECT doc_id, lower(concat_ws(' ', text, CASE doc_id % 3 WHEN 0 THEN 'PYTHON / docker;' WHEN 1 THEN 'sql' ELSE 'pythonic nosqlx' END)) AS body FROM documents) SELECT doc_id, {_all("body", _VOCABULARY.hard_skills(), _WORD)} AS hard FROM f""")
def skills_extract(table):
    text = F.concat_ws(" ", "text", F.when(c("doc_id") % 3 == 0, "PYTHON / docker;").when(c("doc_id") % 3 == 1, "sql").otherwise("pythonic nosqlx"))
    rows = table("documents").select("doc_id", F.lower(text).alias("full"))
    return rows.select("doc_id", p.joined(keywords.all_labels(c("full"), _VOCABULARY.hard_skills(), keywords.Place.WORD)).alias("hard"))


_SKILL_WORDS = [w for _, words in _VOCABULARY.hard_skills() for w in words] + [w for _, words in d.SOFT_SKILLS for w in words] + [w for _, words in d.MAJORS for w in words]


@query(f"""WITH f AS (SELECT doc_id, rtrim(lower(text || CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE chr(10) END || upper(({_list_of(_SKILL_WORDS)})[1 + doc_id % {len(_SKILL_WORDS)}]) || CASE doc_id % 3 WHEN 0 THEN '/' WHEN 1 THEN ' ' ELSE 'x' END || ({_list_of(_SKILL_WORDS)})[1 + doc_id * 7 % {len(_SKILL_WORDS)}])) || ' ' AS body FROM documents)
SELECT doc_id, {_all("body", _VOCABULARY.hard_skills(), _WORD)} AS hard, {_all("body", d.SOFT_SKILLS, _WORD)} AS soft, {_first("body", d.MAJORS, _INSIDE)} AS major FROM f""")
def keyword_labels(table):
    n, words = len(_SKILL_WORDS), keywords.constant(_SKILL_WORDS, "array<string>")
    word = lambda i: F.get(words, (i % n).cast("int"))
    lead = F.when(c("doc_id") % 5 == 0, "").when(c("doc_id") % 5 == 1, "x").otherwise("\n")
    glue = F.when(c("doc_id") % 3 == 0, "/").when(c("doc_id") % 3 == 1, " ").otherwise("x")
    text = F.concat("text", lead, F.upper(word(c("doc_id"))), glue, word(c("doc_id") * 7))
    rows = table("documents").select("doc_id", F.lit("linkedin").alias("website"), text.alias("job_description"), F.lit(None).cast("string").alias("job_requirement"), F.lit("sql").alias("job_category"))
    return p.with_description_fields(rows).select("doc_id", c("hard_skills").alias("hard"), c("soft_skills").alias("soft"), "major")


_LISTED = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query(f"""WITH f AS (SELECT doc_id, lower(concat_ws(' ', text, CASE WHEN doc_id % 2 = 0 THEN 'IELTS 7 / JLPT N2' END)) AS words FROM documents)
SELECT doc_id, nullif(array_to_string(list_sort(list_filter({_LISTED(d.CERTIFICATES)}, lambda x: contains(words, x))), ', '), '') AS certifications,
nullif(concat_ws(', ', {", ".join(f"CASE WHEN len(list_filter({_LISTED(d.LANGUAGE_CERTIFICATES[x])}, lambda x: contains(words, x))) > 0 THEN '{x}' END" for x in sorted(d.LANGUAGE_CERTIFICATES))}), '') AS languages FROM f""")
def cert_language_map(table):
    rows = table("documents").select("doc_id", F.lit("x").alias("website"), c("text").alias("job_description"), F.when(c("doc_id") % 2 == 0, "IELTS 7 / JLPT N2").alias("job_requirement"), F.lit("").alias("job_category"))
    return p.with_description_fields(rows).select("doc_id", "certifications", "languages")


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(p_size * 1000 AS BIGINT) WHEN p_size % 3 = 1 THEN CAST(0 AS BIGINT) ELSE CAST(p_size AS BIGINT) END AS lo, CASE WHEN p_size % 3 = 0 THEN CAST(p_size * 1000 + 99 AS BIGINT) WHEN p_size % 3 = 1 THEN CAST(p_size AS BIGINT) END AS hi FROM part""")
def company_size_parse(table):
    n = c("p_size").cast("string")
    made = p.company_size(F.when(c("p_size") % 3 == 0, F.concat(n, F.lit(".000 - "), n, F.lit(",099"))).when(c("p_size") % 3 == 1, F.concat(F.lit("Ít hơn "), n)).otherwise(F.concat(n, F.lit("+"))))
    return table("part").select("p_partkey", made["company_size_min"].cast("long").alias("lo"), made["company_size_max"].cast("long").alias("hi"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(999 AS BIGINT) WHEN p_size % 3 = 1 THEN CAST(p_size AS BIGINT) ELSE CAST(1 AS BIGINT) END AS n FROM part""")
def headcount_parse(table):
    return table("part").select("p_partkey", p.headcount(F.when(c("p_size") % 3 == 0, "Nhiều"), F.when(c("p_size") % 3 == 1, F.concat(F.lit("Tuyển "), c("p_size").cast("string"), F.lit(" nhân viên")))).alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CASE o_orderkey % 6 WHEN 2 THEN 'Bán thời gian' WHEN 4 THEN 'Thực tập' ELSE '0' END ELSE CAST(o_orderkey % 6 AS VARCHAR) END AS job_type, CASE WHEN o_orderkey % 3 = 0 THEN 'Thỏa thuận' ELSE '10 tr' END AS compensation,
strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') AS job_posted_at, o_orderkey % 5 <> 0 AS is_valid FROM orders""")
def ingest_clean_branches(table):
    rows = table("orders").select(
        "o_orderkey", F.when(c("o_orderkey") % 2 == 0, "VietnamWork ").otherwise("topcv").alias("website"), (c("o_orderkey") % 6).cast("int").alias("job_type"), F.when(c("o_orderkey") % 3 == 0, "Cạnh tranh").otherwise(" 10  tr").alias("compensation"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("job_posted_at"), F.when(c("o_orderkey") % 5 != 0, "t").alias("job_title"), F.lit("u").alias("job_url"), F.lit("2024-01-01 00:00:00").alias("scraped_at"))
    return ingest.cleaned(rows).select("o_orderkey", "job_type", "compensation", "job_posted_at", "is_valid")


@query("SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Toàn thời gian' WHEN '2' THEN 'Bán thời gian' WHEN '3' THEN 'Hợp đồng' WHEN '4' THEN 'Thực tập' WHEN '5' THEN 'Tạm thời' END AS kind FROM orders")
def code_map_lookup(table):
    return table("orders").select("o_orderkey", ingest.mapped(F.substring("o_orderpriority", 1, 1), d.API_JOB_TYPE).alias("kind"))


@query("""SELECT doc_id, doc_id % 2 <> 0 AND doc_id % 3 <> 0 AS is_valid, CASE WHEN doc_id % 6 = 0 THEN 'job_title, job_url' WHEN doc_id % 2 = 0 THEN 'job_title' WHEN doc_id % 3 = 0 THEN 'job_url' ELSE '' END AS missing FROM documents""")
def required_fields_errors(table):
    rows = table("documents").select("doc_id", F.when(c("doc_id") % 2 != 0, "x").alias("job_title"), F.when(c("doc_id") % 3 != 0, "y").otherwise("").alias("job_url"))
    return rows.withColumn("missing", ingest.missing()).select("doc_id", (c("missing") == "").alias("is_valid"), "missing")


@query("SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN NULL ELSE substr('value-' || vec_id, 1, 8) END AS short FROM embeddings")
def truncate_nan_clean(table):
    return table("embeddings").select("vec_id", t.cleaned_value(F.when(c("vec_id") % 2 == 0, "NaN").otherwise(F.concat(F.lit("value-"), "vec_id")), 8).alias("short"))


@query("SELECT c_custkey, lower(trim(c_name, ' ')) AS website FROM customer")
def website_clean(table):
    return table("customer").select("c_custkey", p.website(F.concat(F.lit("\t "), "c_name", F.lit(" \n"))).alias("website"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'Bachelor' END AS education FROM part")
def education_guard(table):
    return table("part").select("p_partkey", p.education_evidence(F.lit("Bachelor"), F.when(c("p_size") % 2 == 0, "college degree"), F.lit("")).alias("education"))


@query(f"""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN {_D} WHEN 1 THEN DATE '2024-03-01' ELSE DATE '2024-02-28' END AS posted, CASE o_orderkey % 5 WHEN 0 THEN {_D} WHEN 1 THEN DATE '2024-05-04' WHEN 2 THEN DATE '2024-06-05' END AS deadline FROM orders""")
def posted_and_deadline(table):
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    posted = F.when(c("o_orderkey") % 3 == 0, day).when(c("o_orderkey") % 3 == 2, "2 ngày trước")
    text = F.when(c("o_orderkey") % 5 == 1, "Hạn nộp: 04/05/2024").when(c("o_orderkey") % 5 == 2, "Please apply before 5-6-2024.").when(c("o_orderkey") % 5 == 3, "deadline: soon")
    made = p.dates(posted, F.when(c("o_orderkey") % 5 == 0, day), F.lit("2024-03-01 09:00:00"), text)
    return table("orders").select("o_orderkey", made["job_posted_at_clean"].alias("posted"), made["job_deadline_clean"].alias("deadline"))


@query("""SELECT event_id, strftime(CASE event_id % 3 WHEN 0 THEN DATE '2024-03-01' - CAST(user_id % 9 AS INTEGER) WHEN 1 THEN DATE '2024-03-01' - CAST(365 * (user_id % 3) AS INTEGER) ELSE DATE '2024-03-01' END, '%Y-%m-%d') AS posted FROM events""")
def english_posted(table):
    text = F.when(c("event_id") % 3 == 0, F.concat((c("user_id") % 9).cast("string"), F.lit(" days ago"))).when(c("event_id") % 3 == 1, F.concat((c("user_id") % 3).cast("string"), F.lit(" years ago"))).otherwise("Just now")
    return table("events").select("event_id", p.iso_posted(text, F.lit("2024-03-01T12:00:00")).alias("posted"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS VARCHAR) WHEN p_size % 3 = 1 THEN '12' END AS years, CASE p_size % 4 WHEN 0 THEN 'Senior' WHEN 1 THEN 'Junior' WHEN 2 THEN 'Intern' END AS level FROM part")
def source_years_and_level(table):
    text = F.when(c("p_size") % 3 == 0, F.concat(F.lit("Needs "), "p_size", F.lit("+ Years of experience, 3 years experience"))).when(c("p_size") % 3 == 1, "12 year experience").otherwise("experience of years")
    title = F.when(c("p_size") % 4 == 0, "Lead to SENIOR dev").when(c("p_size") % 4 == 1, "junior/senior").when(c("p_size") % 4 == 2, "internal tools").otherwise("clerk")
    return table("part").select("p_partkey", p.years_at_source(text).alias("years"), p.level_in_title(title).alias("level"))


# The transform and the load ------------------------------------------------------------------

_CASE = "p_partkey % 8"
_LEVEL_OF = "CASE WHEN p_size < 1.5 THEN 'Fresher' WHEN p_size < 3 THEN 'Junior' WHEN p_size < 5 THEN 'Middle' WHEN p_size < 8 THEN 'Senior' WHEN p_size < 12 THEN 'Lead' ELSE 'Manager+' END"


def _staging(table):
    """A staging row a part: two places, no place and company, an unreadable place list, a blank title, a foreign wage."""
    k, size = c("p_partkey") % 8, c("p_size").cast("string")
    of = lambda engineer, react: F.when(k == 7, react).otherwise(engineer)
    rows = table("part").select(
        c("p_partkey").cast("long").alias("id"), F.concat(F.lit("https://j/"), "p_partkey").alias("job_url"), of(F.lit("TopCV "), F.lit("vietnamwork")).alias("website"), F.when(k == 6, " ").otherwise(of(F.lit("Senior Data Engineer"), F.lit("React programmer"))).alias("job_title"),
        F.when(k == 1, "").otherwise(F.concat(F.lit("CTCP "), F.translate("p_brand", "#", " "))).alias("company_title"), F.when(k == 1, "").when(k == 2, "a,b,c,d,e,f,g,h,i,j").otherwise(of(F.lit("Hà Nội, TP.HCM"), F.lit("Hanoi city, Viet Nam"))).alias("location"),
        F.concat(size, F.lit(" năm")).alias("experience"), of(F.concat(size, F.lit(" - "), (c("p_size") + 5).cast("string"), F.lit(" triệu")), F.concat(F.lit("$"), (c("p_size") + 1000).cast("string"))).alias("compensation"),
        of(F.lit("python, sql. Deadline: 01/03/2026"), F.lit(None)).alias("job_description"), of(F.lit("ielts"), F.lit(None)).alias("job_requirement"), of(F.lit("05/02/2026"), F.lit("3 ngày trước")).alias("job_posted_at"), F.lit("2026-02-10T08:00:00").alias("scraped_at"), F.lit(True).alias("is_valid"))
    return schemas.conformed(rows, schemas.STAGING)


_TRANSFORMED = f"""WITH x AS (SELECT *, {_CASE} AS k FROM part WHERE {_CASE} NOT IN (2, 6)), t AS (SELECT p_partkey AS src_id, 'https://j/' || p_partkey AS job_url, CASE k WHEN 7 THEN 'vietnamwork' ELSE 'topcv' END AS website_clean,
unnest(CASE k WHEN 1 THEN ['Khác'] WHEN 7 THEN ['TP. Hà Nội'] ELSE ['TP. Hà Nội', 'TP. Hồ Chí Minh'] END) AS location_province, CASE k WHEN 7 THEN 'Front-end Developer' ELSE 'Data Engineer' END AS job_title_detect, CASE k WHEN 7 THEN 'Software Development' ELSE 'Data Analytics' END AS job_category_clean,
CASE k WHEN 1 THEN 'Unknown' ELSE 'CÔNG TY CỔ PHẦN ' || upper(replace(p_brand, '#', ' ')) END AS company_title_clean, CASE k WHEN 1 THEN 'Unknown' ELSE 'Cổ phần' END AS company_type, CASE k WHEN 1 THEN NULL ELSE 'cong ty ' || lower(replace(p_brand, '#', ' ')) END AS company_canonical_key,
CAST(CASE k WHEN 7 THEN p_size + 1000 ELSE p_size * 1000000 END AS DOUBLE) AS salary_min, CAST(CASE k WHEN 7 THEN p_size + 1000 ELSE p_size * 1000000 + 5000000 END AS DOUBLE) AS salary_max, CASE k WHEN 7 THEN 'USD' ELSE 'VND' END AS salary_currency, CAST(p_size AS DOUBLE) AS exp_min_yr,
CASE k WHEN 7 THEN {_LEVEL_OF} ELSE 'Senior' END AS level_clean, CASE k WHEN 7 THEN NULL ELSE 'Python, SQL' END AS hard_skills, CASE k WHEN 7 THEN NULL ELSE 'ielts' END AS certifications, CASE k WHEN 7 THEN NULL ELSE 'Tiếng Anh' END AS languages,
CASE k WHEN 7 THEN DATE '2026-02-07' ELSE DATE '2026-02-05' END AS job_posted_at_clean, CASE k WHEN 7 THEN NULL ELSE DATE '2026-03-01' END AS job_deadline_clean FROM x) """


@query(_TRANSFORMED + "SELECT * FROM t")
def etl_transform(table):
    cleaned, _ = transform.transformed(_staging(table), 7)
    return cleaned.select("src_id", "job_url", "website_clean", "location_province", "job_title_detect", "job_category_clean", "company_title_clean", "company_type", "company_canonical_key", "salary_min", "salary_max", "salary_currency", "exp_min_yr", "level_clean", "hard_skills", "certifications", "languages", "job_posted_at_clean", "job_deadline_clean")


@query(f"SELECT p_partkey AS src_id, CASE {_CASE} WHEN 2 THEN 'location' ELSE 'job_title' END AS field_name, CASE {_CASE} WHEN 2 THEN 'TOO_MANY_LOCATIONS' ELSE 'MISSING_TITLE' END AS error_type FROM part WHERE {_CASE} IN (2, 6)")
def etl_errors(table):
    return transform.transformed(_staging(table), 7)[1].select("src_id", "field_name", "error_type")


_UNREAD = f"""WITH s AS (SELECT p_partkey AS src_id, p_size, {_CASE} AS k FROM part), e AS (SELECT src_id, k, p_size, 'location' AS field_name, 'a,b,c,d,e,f,g,h,i,j' AS raw_value, 'TOO_MANY_LOCATIONS' AS error_type FROM s WHERE k = 2
UNION ALL SELECT src_id, k, p_size, 'job_title', ' ', 'MISSING_TITLE' FROM s WHERE k = 6 UNION ALL SELECT src_id, k, p_size, 'job_posted_at', 'soon ' || p_size, 'PARSE_FAIL' FROM s WHERE k IN (3, 5)
UNION ALL SELECT src_id, k, p_size, 'number_recruit', 'many', 'PARSE_FAIL' FROM s WHERE k IN (4, 5) UNION ALL SELECT src_id, k, p_size, 'company_size', 'a few', 'PARSE_FAIL' FROM s WHERE k = 7) """


def _two_runs(table) -> tuple[str, str]:
    """Staging rows with fields that cannot be read, all of them and then those of large parts again; where errors and log are."""
    k = c("p_partkey") % 8
    rows = _staging(table).join(table("part").select(c("p_partkey").cast("long").alias("id"), "p_size", k.alias("k")), "id").withColumns({
        "job_posted_at": F.when(c("k").isin(3, 5), F.concat(F.lit("soon "), "p_size")).otherwise(c("job_posted_at")), "number_recruit": F.when(c("k").isin(4, 5), "many"), "company_size": F.when(c("k") == 7, "a few")})
    spark = rows.sparkSession
    store, errors, log = nightly.cleaned_at(lineage.fresh_path(spark, "cleaned"), 16).create(spark), lineage.fresh_path(spark, "errors"), lineage.fresh_path(spark, "log")
    nightly.run(rows, store, errors, log, 7, "full")
    nightly.run(rows.where("p_size > 25"), store, errors, log, 8)
    return errors, log


@query(_UNREAD + "SELECT 7 AS run_id, src_id, field_name, raw_value, error_type FROM e UNION ALL SELECT 8, src_id, field_name, raw_value, error_type FROM e WHERE p_size > 25")
def error_append(table):
    errors, _ = _two_runs(table)
    return nightly.errors_of(table("part").sparkSession, errors).select("run_id", "src_id", "field_name", "raw_value", "error_type")


@query(_UNREAD + """, r AS (SELECT 7 AS run_id, 'full' AS mode, 0 AS least UNION ALL SELECT 8, 'today', 25), i AS (SELECT run_id, mode, count(*) AS total_input, CAST(sum(CASE WHEN k IN (2, 6) THEN 0 WHEN k IN (1, 7) THEN 1 ELSE 2 END) AS BIGINT) AS total_output
FROM r, s WHERE p_size > least GROUP BY ALL), f AS (SELECT run_id, count(*) AS error_rows FROM r, e WHERE p_size > least GROUP BY ALL)
SELECT run_id, mode, total_input, total_output, CASE run_id WHEN 7 THEN total_output ELSE 0 END AS new_rows, CASE run_id WHEN 8 THEN total_output ELSE 0 END AS updated_rows, error_rows,
CASE WHEN error_rows > 0.2 * total_input THEN 'WARN' ELSE 'SUCCESS' END AS status FROM i JOIN f USING (run_id)""")
def run_log_observed(table):
    _, log = _two_runs(table)
    return nightly.log_of(table("part").sparkSession, log).select("run_id", "mode", "total_input", "total_output", "new_rows", "updated_rows", "error_rows", "status")


@query(_TRANSFORMED + """SELECT job_url, location_province AS tinh_thanh, company_title_clean AS ten_cong_ty, 'Không xác định' AS cap_do_1, level_clean AS ten_cap_bac, 'Full-time' AS job_type, website_clean AS ten_nguon, job_category_clean AS ten_danh_muc, job_title_detect,
CAST(round((salary_min + salary_max) / 2) AS DECIMAL(18,0)) AS salary_avg, job_posted_at_clean AS ngay_dang, CAST(1 AS DECIMAL(18,0)) AS so_luong_tuyen, count(*) OVER () AS postings, count(*) OVER () AS last_id,
CAST(CASE WHEN hard_skills IS NULL THEN 0 ELSE 4 END AS BIGINT) AS requirements FROM t""")
def etl_to_star(table):
    """The nightly run: transform, load, and the postings with the names of all their dimensions."""
    cleaned = lineage.settled(transform.transformed(_staging(table), 7)[0], "cleaned")
    tables = warehouse.load(warehouse.empty(cleaned.sparkSession), cleaned, "2026-02-11")
    asked = tables["bridge_jobrequire"].groupBy(c("fact_id").alias("posting_id")).agg(F.count("*").alias("requirements"))
    whole = tables["fact_jobpostings"].agg(F.countDistinct("posting_id").alias("postings"), F.max("posting_id").alias("last_id"))
    named = warehouse.postings(tables).join(asked, "posting_id", "left").crossJoin(F.broadcast(whole))  # one row
    return named.select("job_url", "tinh_thanh", "ten_cong_ty", "cap_do_1", "ten_cap_bac", "job_type", "ten_nguon", "ten_danh_muc", "job_title_detect", "salary_avg", "ngay_dang", "so_luong_tuyen", "postings", "last_id", F.coalesce("requirements", F.lit(0)).cast("long").alias("requirements"))


def _cleaned(table):
    """Cleaned rows, two a part, with hashed ids."""
    rows = table("part").select("*", F.explode(F.array(F.lit("TP. Hà Nội"), F.lit("Huế"))).alias("place"))
    rows = rows.select(
        F.xxhash64("p_partkey", "place").alias("etl_id"), F.concat(F.lit("https://j/"), "p_partkey").alias("job_url"), F.when(c("p_size") % 5 != 0, c("place")).alias("location_province"), F.lit("Bắc").alias("location_region"), F.lit(True).alias("is_vn"),
        c("p_brand").alias("company_title_clean"), F.when(c("p_size") % 2 == 0, c("p_type")).alias("company_canonical_key"), F.when(c("p_size") % 3 != 0, c("p_type")).alias("industry_level1"), F.when(c("p_size") % 3 == 1, c("p_brand")).alias("industry_level2"),
        F.lit("Senior").alias("level_clean"), F.lit(" ").alias("job_type_clean"), F.lit("Remote").alias("work_mode_clean"), F.lit("topcv").alias("website_clean"), F.lit("Data").alias("job_category_clean"), F.replace("p_name", F.lit(" "), F.lit(", ")).alias("hard_skills"), c("p_brand").alias("major"),
        c("p_size").cast("double").alias("salary_min"), F.lit(False).alias("is_negotiable"), F.lit(True).alias("is_valid"), F.lit(7).alias("etl_run_id"), F.lit("2026-02-10").alias("scraped_at"), (c("p_size") % 4 == 0).alias("is_duplicate"), F.when(c("p_size") % 4 == 0, F.xxhash64("p_partkey")).alias("duplicate_of_id"))
    return schemas.conformed(rows, schemas.CLEANED)


def _star_of(table, loads: int = 1):
    rows = _cleaned(table)
    tables = warehouse.empty(rows.sparkSession)
    for i in range(loads):
        # The second load is of one run, onto what the first has made.
        tables = warehouse.load(tables, rows, f"2026-02-1{i}", "all" if not i else "today", "7")
    return tables


@query("""SELECT 'https://j/' || p_partkey AS job_url, CASE WHEN p_size % 5 <> 0 THEN place ELSE 'Khác' END AS tinh_thanh, p_brand AS ten_cong_ty, CASE WHEN p_size % 3 <> 0 THEN p_type ELSE 'Không xác định' END AS cap_do_1,
CASE WHEN p_size % 3 = 1 THEN p_brand WHEN p_size % 3 = 0 THEN 'Không xác định' END AS cap_do_2, CAST(p_size AS DECIMAL(18,0)) AS salary_avg, p_size % 4 = 0 AS is_duplicate, p_size % 4 = 0 AS linked FROM part, (SELECT unnest(['TP. Hà Nội', 'Huế']) AS place)""")
def load_fact(table):
    return warehouse.postings(_star_of(table)).select("job_url", "tinh_thanh", "ten_cong_ty", "cap_do_1", "cap_do_2", "salary_avg", "is_duplicate", (c("duplicate_of_id") == F.xxhash64(F.replace("job_url", F.lit("https://j/"), F.lit("")).cast("long"))).alias("linked_right")).select("job_url", "tinh_thanh", "ten_cong_ty", "cap_do_1", "cap_do_2", "salary_avg", "is_duplicate", F.coalesce("linked_right", F.lit(False)).alias("linked"))


@query("""SELECT DISTINCT 'https://j/' || p_partkey AS job_url, v.t AS require_type, trim(v.w, ' ') AS require_value, CAST(2 AS BIGINT) AS postings FROM part, LATERAL (SELECT 'hard_skill' AS t, unnest(string_split(p_name, ' ')) AS w UNION ALL SELECT 'major', p_brand) v WHERE trim(v.w, ' ') <> ''""")
def load_bridge(table):
    tables = _star_of(table)
    both = tables["bridge_jobrequire"].join(tables["fact_jobpostings"].select(c("posting_id").alias("fact_id"), "job_url"), "fact_id").join(tables["dim_require"], "require_id")
    return both.groupBy("job_url", "require_type", "require_value").agg(F.count("*").alias("postings"))


@query("""SELECT 'dim_congty' AS name, p_brand AS a, max(CASE WHEN p_size % 2 = 0 THEN p_type END) AS b FROM part GROUP BY p_brand UNION ALL SELECT DISTINCT 'dim_nganh', p_type, CASE WHEN p_size % 3 = 1 THEN p_brand END FROM part WHERE p_size % 3 <> 0 UNION ALL SELECT 'dim_nganh', 'Không xác định', 'Không xác định'
UNION ALL SELECT DISTINCT 'dim_diadiem', place, 'Bắc' FROM part, (SELECT unnest(['TP. Hà Nội', 'Huế']) AS place) WHERE p_size % 5 <> 0 UNION ALL SELECT 'dim_diadiem', 'Khác', 'Khác' UNION ALL SELECT 'dim_capbac', 'Senior', NULL UNION ALL SELECT 'dim_hinhthuc', 'Full-time', 'Remote'
UNION ALL SELECT 'dim_nguon', 'topcv', NULL UNION ALL SELECT 'dim_danhmuccongviec', 'Data', NULL""")
def load_dimensions(table):
    tables = _star_of(table)
    shown = {"dim_congty": ("ten_cong_ty", "canonical_key"), "dim_nganh": ("cap_do_1", "cap_do_2"), "dim_diadiem": ("tinh_thanh", "vung"), "dim_capbac": ("ten_cap_bac",), "dim_hinhthuc": ("job_type", "work_mode"), "dim_nguon": ("ten_nguon",), "dim_danhmuccongviec": ("ten_danh_muc",)}
    rows = [tables[n].select(F.lit(n).alias("name"), c(x[0]).alias("a"), (c(x[1]) if len(x) > 1 else F.lit(None).cast("string")).alias("b")) for n, x in shown.items()]
    return functools.reduce(DataFrame.unionByName, rows)


@query("""WITH p AS (SELECT 2 * count(*) AS n FROM part), w AS (SELECT DISTINCT p_partkey, t, trim(w, ' ') AS w FROM part, LATERAL (SELECT 'hard_skill' AS t, unnest(string_split(p_name, ' ')) AS w UNION ALL SELECT 'major', p_brand) v WHERE trim(w, ' ') <> '')
SELECT 'fact_jobpostings' AS name, n AS rows, n AS ids, CAST(1 AS BIGINT) AS first_id, n AS last_id FROM p UNION ALL SELECT 'bridge_jobrequire', 2 * count(*), 2 * count(*), 1, 2 * count(*) FROM w
UNION ALL SELECT 'dim_require', count(*), count(*), 1, count(*) FROM (SELECT DISTINCT t, w FROM w) UNION ALL SELECT 'dim_congty', count(DISTINCT p_brand), count(DISTINCT p_brand), 1, count(DISTINCT p_brand) FROM part""")
def load_twice_numbers(table):
    """Ids of the tables that grow are distinct and without gaps, also after a second load."""
    tables = _star_of(table, 2)
    ids = {"fact_jobpostings": "posting_id", "bridge_jobrequire": "bridge_id", "dim_require": "require_id", "dim_congty": "cong_ty_id"}
    rows = [tables[n].agg(F.lit(n).alias("name"), F.count("*").alias("rows"), F.countDistinct(k).alias("ids"), F.min(k).alias("first_id"), F.max(k).alias("last_id")) for n, k in ids.items()]
    return functools.reduce(DataFrame.unionByName, rows)


def _service(first: bool):
    """A service that is away for some texts in the first run and never answers others."""
    def ask(text: dict[str, str]) -> str:
        size = int(text["job_description"].split("-")[1])
        if first and size % 7 == 1:
            raise TimeoutError("away")
        return "no" if size % 10 == 0 else '```json {"job_title": "", "job_requirement": "%s", "level": "L%d"} ```' % (text["job_description"].lower(), size)

    return ask


@query("""SELECT p_partkey AS id, p_brand AS job_title, CASE WHEN p_size % 10 > 0 THEN lower(p_type) || '-' || p_size END AS job_requirement, CASE WHEN p_size % 10 > 0 THEN 'L' || p_size ELSE 'old' END AS level, p_size % 10 > 0 AS ai_processed,
CASE WHEN p_size % 10 = 0 OR p_size % 7 = 1 THEN 2 ELSE 1 END AS tries, CASE WHEN p_size % 10 = 0 THEN 'no JSON object: no' END AS failure FROM part""")
def structured_by_content(table):
    rows = table("part").select(c("p_partkey").alias("id"), c("p_brand").alias("job_title"), F.concat_ws("-", "p_type", "p_size").alias("job_description"), F.lit(None).cast("string").alias("job_requirement"), F.lit("old").alias("level"), F.lit("2026-01-01").alias("scraped_at"), F.lit(False).alias("ai_processed"))
    spark, texts = rows.sparkSession, ("job_description",)
    kept = structuring.kept_at(lineage.fresh_path(spark, "answers"), 16).create(spark)
    for n in (1, 2):
        structuring.run(spark, rows, kept, _service(n == 1), n, most=None, tasks=8, texts=texts)
    answers = kept.read(spark)
    done = structuring.structured(rows, answers, "job_title string, job_requirement string, level string", texts)
    state = rows.select("id", structuring.content(texts).alias("content")).join(answers.select("content", "tries", "failure"), "content").drop("content")
    return done.drop("job_description", "scraped_at").join(state, "id")


# Market questions ----------------------------------------------------------------------------

_STAR = "orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"


def _star(table):
    return table("orders").join(table("customer"), c("o_custkey") == c("c_custkey")).join(table("nation"), c("c_nationkey") == c("n_nationkey")).join(table("region"), c("n_regionkey") == c("r_regionkey"))


@query(f"SELECT r_name, count(*) AS demand, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share FROM {_STAR} GROUP BY r_name")
def bi_share_location(table):
    return analytics.share(_star(table), "r_name", F.lit(1))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, count(*) AS demand FROM orders GROUP BY 1, 2")
def bi_by_quarter(table):
    return analytics.by_quarter(table("orders"), "o_orderdate", F.lit(1))


@query(f"SELECT c_mktsegment, count(*) AS demand, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share FROM {_STAR} GROUP BY c_mktsegment")
def bi_industry(table):
    return analytics.share(_star(table), "c_mktsegment", F.lit(1))


@query("""SELECT p_brand, CASE WHEN p_size < 3 THEN 'Dưới 3 triệu' WHEN p_size < 10 THEN '3 – 10 triệu' WHEN p_size < 15 THEN '10 – 15 triệu' WHEN p_size < 25 THEN '15 – 25 triệu' WHEN p_size < 35 THEN '25 – 35 triệu' WHEN p_size < 50 THEN '35 – 50 triệu' ELSE 'Hơn 50 triệu' END AS bin, count(*) AS postings FROM part GROUP BY 1, 2""")
def bi_salary_bins(table):
    return analytics.salary_bins(table("part"), c("p_size") * 1_000_000, ["p_brand"])


def _month_sketches(table):
    """Sketches of order totals by month, priority and status, as a table."""
    return lineage.settled(analytics.salary_sketches(table("orders"), "o_orderdate", ["o_orderpriority", "o_orderstatus"], c("o_totalprice")), "sketches")


@query("""WITH q AS (SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, o_orderpriority, o_totalprice AS x FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL)
SELECT year, quarter, o_orderpriority, count(*) AS postings, min(CAST(x AS DOUBLE)) AS q0, max(CAST(x AS DOUBLE)) AS q100, true AS near FROM q GROUP BY ALL""")
def bi_sketched_quarters(table):
    """Quarters from the sketches of their months; `near`: the median found is within the stated rank error of the rows' own."""
    by = [F.year("month").alias("year"), F.quarter("month").alias("quarter"), "o_orderpriority"]
    found = lineage.settled(analytics.salary_quantiles(_month_sketches(table), by, (0.0, 0.5, 1.0)), "quantiles")
    keys = ["year", "quarter", "o_orderpriority"]
    rows = table("orders").select(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"), "o_orderpriority", c("o_totalprice").cast("double").alias("amount"))
    errors = analytics.rank_errors(rows, found, keys, "amount", "q50", 0.5).select(*keys, (c("rank_error") <= analytics.RANK_ERROR).alias("near"))
    return found.join(errors, keys).select(*[c(k).cast("long").alias(k) for k in keys[:2]], "o_orderpriority", "postings", "q0", "q100", "near")


@query("""SELECT o_orderstatus, count(*) AS postings, true AS q25_near, true AS q75_near FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate >= DATE '1994-03-01' AND o_orderdate < DATE '1997-06-01' GROUP BY ALL""")
def bi_sketched_range(table):
    found = lineage.settled(analytics.salary_quantiles(_month_sketches(table), ["o_orderstatus"], (0.25, 0.75), "1994-03-01", "1997-06-01"), "quantiles")
    rows = table("orders").where("o_orderdate >= date'1994-03-01' and o_orderdate < date'1997-06-01'").select("o_orderstatus", c("o_totalprice").cast("double").alias("amount"))
    near = [analytics.rank_errors(rows, found, ["o_orderstatus"], "amount", q, share).select("o_orderstatus", (c("rank_error") <= analytics.RANK_ERROR).alias(f"{q}_near")) for q, share in (("q25", 0.25), ("q75", 0.75))]
    return found.join(near[0], "o_orderstatus").join(near[1], "o_orderstatus").select("o_orderstatus", "postings", "q25_near", "q75_near")


@query("""SELECT CASE WHEN x = 0 THEN 'Không yêu cầu' WHEN x < 1 THEN 'Dưới 1 năm' WHEN x < 3 THEN '1 – 3 năm' WHEN x < 5 THEN '3 – 5 năm' ELSE 'Trên 5 năm' END AS band, count(*) AS postings, CAST(median(p_size) AS DOUBLE) AS median_salary FROM (SELECT p_size % 8 AS x, p_size FROM part) GROUP BY 1""")
def bi_exp_bins(table):
    return analytics.experience_bins(table("part"), c("p_size") % 8, c("p_size"))


@query(_REQUIREMENTS + "SELECT p_brand AS job_title_detect, require_value, count(*) AS postings FROM q JOIN part ON etl_id = p_partkey WHERE require_type = 'hard_skill' GROUP BY 1, 2")
def bi_skill_by_role(table):
    rows = _requirements(table)
    dim = rows.select("require_type", "require_value").distinct().withColumn("require_id", F.xxhash64("require_type", "require_value"))
    tables = {"fact_jobpostings": table("part").select(c("p_partkey").alias("posting_id"), c("p_brand").alias("job_title_detect")), "dim_require": dim, "bridge_jobrequire": rows.join(dim, ["require_type", "require_value"]).select(c("etl_id").alias("fact_id"), "require_id")}
    return analytics.skills_by_role(tables)


@query(_CHAINS + "SELECT count(*) AS all_postings, count(*) FILTER (WHERE event_id = root) AS unique_postings FROM h")
def bi_all_vs_unique(table):
    return analytics.all_against_unique(_chained(table).withColumn("is_duplicate", c("event_id") != c("root")))


@query(f"""WITH dim AS (SELECT DISTINCT trim(r_name, ' ') AS region FROM region), fact AS (SELECT o_orderkey, r_name FROM (SELECT o.o_orderkey, r.r_name, row_number() OVER (PARTITION BY o.o_orderkey ORDER BY o.o_orderdate DESC NULLS LAST, o.o_custkey) AS rn FROM {_STAR}) WHERE rn = 1)
SELECT coalesce(region, 'Khác') AS region, count(*) AS demand, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share FROM fact LEFT JOIN dim ON trim(r_name, ' ') = region GROUP BY 1""")
def demand_share(table):
    """Scan, trimmed dimension, latest row a key, default join, share: the whole path in one query."""
    dim = warehouse.distinct_trimmed(table("region"), "r_name", "region")
    fact = windows.latest(_star(table), ["o_orderkey"], F.desc_nulls_last("o_orderdate"), "o_custkey").select("o_orderkey", F.trim("r_name").alias("k"))
    return analytics.share(fact.join(dim, c("k") == c("region"), "left").withColumn("region", F.coalesce("region", F.lit(d.OTHER_PLACE))), "region", F.lit(1))
