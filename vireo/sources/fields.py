"""Fields of saved job pages: a page becomes an outline once, and a table of rules a site picks each field from it.

A rule is a path of steps through the elements and what to take at its end. Pages
are independent, so Spark deals them to tasks; nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.sources.tables import detail_else_card

# Markup --------------------------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CODE = frozenset(("script", "style"))
#: A start tag that ends an open element of the same kind, up to the element that may hold several.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Start tags that end an open paragraph.
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
P_ENDS = ({"p"}, {"td", "th", "table", "button"})


@dataclass
class Element:
    tag: str
    attrs: dict[str, str]
    parent: int
    kids: list[int]
    #: The last element inside, and the pieces of text from and to.
    last: int
    start: int
    end: int


class Outline(HTMLParser):
    """The elements of a page in order (number 0 stands around all), and its pieces of text, each with the element it is directly in.

    Scripts and styles have no text; unclosed elements end with what holds them.
    """

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.elements = [Element("", {}, -1, [], 0, 0, 0)]
        self.pieces: list[str] = []
        self.owners: list[int] = []
        self.by_tag: dict[str, list[int]] = {}
        self._open = [0]
        self._count: dict[str, int] = {}
        self._found: dict[str, list[int]] = {}
        self.feed(page)
        self.close()
        while self._open:
            self._end()
        self.text = "".join(self.pieces)
        self.offsets = [0]
        for piece in self.pieces:
            self.offsets.append(self.offsets[-1] + len(piece))

    def _end(self) -> None:
        e = self.elements[self._open.pop()]
        e.last, e.end = len(self.elements) - 1, len(self.pieces)
        self._count[e.tag] = self._count.get(e.tag, 0) - 1

    def _end_any(self, kinds: set[str], within: set[str]) -> None:
        """End the innermost open element of the kinds unless one of `within` is met first."""
        if any(self._count.get(k, 0) > 0 for k in kinds):
            for depth in range(len(self._open) - 1, 0, -1):
                tag = self.elements[self._open[depth]].tag
                if tag in kinds:
                    while len(self._open) > depth:
                        self._end()
                    return
                if tag in within:
                    return

    def handle_starttag(self, tag, attrs) -> None:
        if tag in BLOCKS:
            self._end_any(*P_ENDS)
        if tag in ENDS:
            self._end_any(*ENDS[tag])
        at, n = len(self.elements), len(self.pieces)
        self.elements.append(Element(tag, {k: v or "" for k, v in reversed(attrs)}, self._open[-1], [], at, n, n))
        self.elements[self._open[-1]].kids.append(at)
        self.by_tag.setdefault(tag, []).append(at)
        if tag not in VOID:
            self._open.append(at)
            self._count[tag] = self._count.get(tag, 0) + 1

    def handle_endtag(self, tag) -> None:
        if self._count.get(tag, 0) > 0:
            while self.elements[self._open[-1]].tag != tag:
                self._end()
            self._end()

    def handle_data(self, data) -> None:
        if data.strip() and self.elements[self._open[-1]].tag not in CODE:
            self.pieces.append(data)
            self.owners.append(self._open[-1])

    def own(self, at: int) -> list[int]:
        """The pieces directly in an element."""
        e = self.elements[at]
        return [i for i in range(e.start, e.end) if self.owners[i] == at]

    def holds(self, at: int, words: str) -> bool:
        """Whether the whole text of an element holds the words; they are looked for once a page."""
        if words not in self._found:
            places, i = [], self.text.find(words)
            while i >= 0:
                places.append(i)
                i = self.text.find(words, i + 1)
            self._found[words] = places
        e, places = self.elements[at], self._found[words]
        i = bisect_left(places, self.offsets[e.start])
        return i < len(places) and places[i] + len(words) <= self.offsets[e.end]


# Rules ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Step:
    """From an element to others, in page order: to those of `tag` (any: "") that are `below`, a `child`,
    `after` (later children of the same parent) or `around` it, where all that is given holds.

    words: the class attribute has each of these words; part: it contains this text; cls: it is this text;
    id; attr: the attribute is there; says: a text directly inside contains this; text: one is this, trimmed;
    holds: the whole text contains this; has: this path leads somewhere; nth: of those left, counted from each start, the nth only.
    """

    axis: str
    tag: str = ""
    words: str = ""
    part: str = ""
    cls: str = ""
    id: str = ""
    attr: str = ""
    says: str = ""
    text: str = ""
    holds: str = ""
    has: tuple[Step, ...] = ()
    nth: int = 0

    def candidates(self, page: Outline, at: int) -> list[int]:
        e = page.elements[at]
        if self.axis == "below":
            if not self.tag:
                return list(range(at + 1, e.last + 1))
            known = page.by_tag.get(self.tag, [])
            return known[bisect_left(known, at + 1):bisect_left(known, e.last + 1)]
        if self.axis == "child":
            found = e.kids
        elif self.axis == "after":
            beside = page.elements[e.parent].kids if e.parent >= 0 else []
            found = beside[bisect_left(beside, at + 1):]
        else:
            found = []
            while e.parent > 0:
                found.append(e.parent)
                e = page.elements[e.parent]
        return [i for i in found if self.tag in ("", page.elements[i].tag)]

    def fits(self, page: Outline, at: int) -> bool:
        e = page.elements[at]
        named = e.attrs.get("class", "")
        return (
            (not self.words or set(self.words.split()) <= set(named.split())) and self.part in named and self.cls in ("", named)
            and self.id in ("", e.attrs.get("id")) and (not self.attr or self.attr in e.attrs)
            and (not self.says or any(self.says in page.pieces[i] for i in page.own(at)))
            and (not self.text or any(self.text == page.pieces[i].strip() for i in page.own(at)))
            and (not self.holds or page.holds(at, self.holds)) and (not self.has or bool(reached(page, self.has, at))))


def reached(page: Outline, path: tuple[Step, ...], at: int = 0) -> list[int]:
    """The elements at the end of a path, each once, in page order."""
    here = [at]
    for step in path:
        out: set[int] = set()
        for start in here:
            fit = [i for i in step.candidates(page, start) if step.fits(page, i)]
            out.update(fit[step.nth - 1:step.nth] if step.nth else fit)
        here = sorted(out)
    return here


@dataclass(frozen=True)
class Rule:
    """What a field is: at the end of the path the texts directly inside (`own`), all texts inside (`all`) or an
    attribute; of those that are not blank and do not hold `without` (in any case), trimmed, the first, the last or all with `joined` between."""

    path: tuple[Step, ...]
    take: str = "own"
    last: bool = False
    joined: str | None = None
    without: str = ""

    def value(self, page: Outline) -> str | None:
        ends = reached(page, self.path)
        if self.take == "own":
            found = [page.pieces[i] for at in ends for i in page.own(at)]
        elif self.take == "all":
            inside = sorted({i for at in ends for i in range(page.elements[at].start, page.elements[at].end)})
            found = [page.pieces[i] for i in inside]
        else:
            found = [page.elements[at].attrs.get(self.take, "") for at in ends]
        found = [x.strip() for x in found if x.strip() and not (self.without and self.without in x.lower())]
        if not found:
            return None
        return self.joined.join(found) if self.joined is not None else found[-1 if self.last else 0]


def below(tag: str = "", **tests) -> Step:
    return Step("below", tag, **tests)


def child(tag: str = "", **tests) -> Step:
    return Step("child", tag, **tests)


def after(tag: str = "", **tests) -> Step:
    return Step("after", tag, **tests)


def around(tag: str = "", **tests) -> Step:
    return Step("around", tag, **tests)


def first(*path: Step, take: str = "own") -> Rule:
    return Rule(path, take)


def every(*path: Step, take: str = "all", joined: str = " ") -> Rule:
    return Rule(path, take, joined=joined)


# Where each site's pages hold a field -------------------------------


def _careerlink() -> dict[str, Rule]:
    labelled = lambda label: first(below("div", says=label), after("div"))
    section = lambda name: every(below("div", id=name), below("div", part="rich-text-content"))
    return {
        "job_title": first(below(words="job-title")),
        "company_title": first(below(words="company-info"), below(words="company-name-title"), below("a"), below("span")),
        "location": first(below("div", id="job-location"), below("a"), take="title"),
        "experience": labelled("Kinh nghiệm"),
        "compensation": first(below("div", id="job-salary"), child("span", part="text-primary")),
        "job_type": labelled("Loại công việc"),
        "level": labelled("Cấp bậc"),
        "company_size": first(below("i", part="cli-users"), after("span")),
        "company_industry": every(below("div", says="Ngành nghề"), after("div"), below("span"), take="own", joined=" / "),
        "education_level": labelled("Học vấn"),
        "job_description": section("section-job-description"),
        "job_requirement": section("section-job-skills"),
        "job_posted_at": Rule((below("div", part="date-from"), below("span", cls="d-flex")), last=True),
        "job_deadline": first(below("div", id="job-date"), below("div", part="day-expired"), below("b")),
    }


def _careerviet() -> dict[str, Rule]:
    item = lambda label: (below("li", has=(below("strong", holds=label),)), child("p"))
    section = lambda heading: every(below("div", has=(child("h2", says=heading),)), below("div"))
    return {
        "job_title": first(below(words="job-desc"), below("h1")),
        "location": first(below(words="detail-box"), below(words="map"), below("p"), below("a")),
        "experience": first(*item("Kinh nghiệm")),
        "compensation": first(*item("Lương")),
        "job_type": first(*item("Hình thức")),
        "level": first(*item("Cấp bậc")),
        "company_industry": first(*item("Ngành nghề"), take="all"),
        "education_level": Rule((below("li", holds="Bằng cấp"),), last=True),
        "job_description": section("Mô tả Công việc"),
        "job_requirement": section("Yêu Cầu Công Việc"),
        "job_posted_at": first(*item("Ngày cập nhật")),
        "job_deadline": first(*item("Hết hạn nộp")),
        "company_url": first(below(words="job-desc"), below("a"), take="href"),
    }


def _joboko() -> dict[str, Rule]:
    beside = lambda label: first(below("div", part="item-content", holds=label), child("span", cls="fw-bold"))
    under = lambda label: first(below("div", part="nw-job-detail__heading", holds=label), after("div", part="nw-job-detail__text", nth=1))
    return {
        "job_title": first(below("h1", words="nw-company-hero__title"), below("a")),
        "company_title": first(below("a", part="nw-company-hero__text")),
        "location": every(below(words="nw-company-hero__address"), below("a"), take="own", joined=", "),
        "experience": beside("Kinh nghiệm"),
        "compensation": beside("Thu nhập"),
        "job_type": beside("Loại hình"),
        "level": beside("Chức vụ"),
        "company_size": under("Quy mô công ty"),
        "job_description": every(below("div", cls="text-left job-desc")),
        "job_requirement": every(below("div", cls="text-left job-requirement")),
        "job_posted_at": under("Ngày làm mới"),
        "job_deadline": first(below("em", words="item-date"), take="data-value"),
    }


def _timviec365() -> dict[str, Rule]:
    labelled = lambda label: first(below("p", text=label), after("p"))
    links = lambda label: every(below("p", says=label), after("div"), below("a"), take="own")
    return {
        "job_title": first(below(words="boxTitleNameNtd"), below("h1")),
        "company_title": first(below(words="boxTitleNameNtd"), below("a")),
        "location": labelled("Địa điểm"),
        "experience": labelled("Kinh nghiệm"),
        "compensation": first(below(words="valContentSalary txtSalaryNew")),
        "job_type": labelled("Hình thức làm việc"),
        "level": labelled("Chức vụ"),
        "company_industry": links("Ngành nghề"),
        "job_category": links("Lĩnh vực"),
        "number_recruit": labelled("Số lượng cần tuyển"),
        "education_level": labelled("Bằng cấp"),
        "job_description": every(below("h2", text="Mô tả công việc"), around("div", cls="itemInfoSpecific"), below("div", cls="valInfoSpecific")),
        "job_requirement": every(below(words="boxYeuCauKhac"), below(words="valInfoSpecific w100"), below()),
        "job_posted_at": first(below("span", words="timeUpdate dataNewReal")),
        "job_deadline": first(below(words="valHanNop")),
    }


def _vieclam24h() -> dict[str, Rule]:
    pair = lambda label: below("div", has=(child("div", text=label),))
    marked = lambda label: first(pair(label), child("div", part="text-14"))
    second = lambda label: first(pair(label), child("div", nth=2))
    section = lambda heading: every(below("h2", says=heading), after("div", nth=1))
    return {
        "job_title": first(below("h1")),
        "company_title": first(below("i", part="svicon-users"), around("div", part="flex flex-col gap-3"), below("a", attr="title"), child("div")),
        "location": first(pair("Khu vực tuyển"), below("a"), child("span")),
        "experience": marked("Yêu cầu kinh nghiệm"),
        "compensation": marked("Mức lương"),
        "job_type": second("Hình thức làm việc"),
        "level": second("Cấp bậc"),
        "company_size": first(below("i", part="svicon-users"), after("div")),
        "company_industry": every(pair("Ngành nghề"), below("a"), take="own"),
        "number_recruit": second("Số lượng tuyển"),
        "education_level": marked("Yêu cầu bằng cấp"),
        "job_description": section("Mô tả công việc"),
        "job_requirement": section("Yêu cầu công việc"),
        "job_posted_at": second("Ngày đăng"),
        "job_deadline": first(below("div", says="Hạn nộp hồ sơ"), after("div", nth=1)),
    }


def _topcv() -> dict[str, Rule]:
    pair = lambda label: first(below("div", has=(child("div", says=label),)), child("div", part="value"), take="all")
    section = lambda heading: every(below("h3", says=heading), after("div", cls="job-description__item--content"), below())
    return {
        "job_title": every(below("h1", part="job-detail__info--title")),
        "company_title": first(below("a", words="name")),
        "location": every(below("div", part="job-detail__info--section-content-title", says="Địa điểm"), after("div")),
        "experience": pair("Kinh nghiệm"),
        "compensation": pair("Mức lương"),
        "job_type": pair("Hình thức làm việc"),
        "work_mode": every(below("h3", says="Thời gian làm việc"), after("div")),
        "level": pair("Cấp bậc"),
        "company_size": first(below("div", part="company-scale"), below("div", cls="company-value"), take="all"),
        "company_industry": first(below("div", cls="company-title", holds="Lĩnh vực:"), after("div", cls="company-value"), take="all"),
        "number_recruit": pair("Số lượng tuyển"),
        "education_level": pair("Học vấn"),
        "job_description": section("Mô tả công việc"),
        "job_requirement": section("Yêu cầu ứng viên"),
        "job_deadline": first(below("div", words="job-detail__info--deadline-date")),
    }


def _jobsgo() -> dict[str, Rule]:
    inside = lambda label: (below("span", holds=label), child("strong"))
    beside = lambda label: first(below("span", holds=label), after("strong"))
    section = lambda heading: every(below("h3", says=heading), after("div", nth=1))
    return {
        "job_title": first(below("h1", words="job-title")),
        "company_title": first(below("h6", words="fw-semibold")),
        "location": every(*inside("Địa điểm")),
        "experience": first(*inside("Kinh nghiệm")),
        "compensation": first(*inside("Mức lương")),
        "job_type": beside("Loại hình"),
        "level": beside("Cấp bậc"),
        "job_category": every(below("div", part="text-muted", says="Ngành nghề:"), after("strong"), below("a"), take="own"),
        "number_recruit": first(below("span", part="text-muted", says="Số lượng tuyển:"), after("strong")),
        "education_level": first(*inside("Bằng cấp")),
        "job_description": section("Mô tả công việc"),
        "job_requirement": section("Yêu cầu công việc"),
        "job_posted_at": beside("Ngày đăng tuyển"),
        "job_deadline": beside("Hạn nộp hồ sơ"),
        "company_url": first(below("div", words="card-company"), below("a"), take="href"),
    }


POSTING_RULES = {"careerlink": _careerlink(), "careerviet": _careerviet(), "joboko": _joboko(), "timviec365": _timviec365(), "vieclam24h": _vieclam24h(), "topcv": _topcv(), "jobsgo": _jobsgo()}
#: The company's own page, where the posting's page does not say.
COMPANY_RULES = {
    "careerviet": {"company_title": first(below(words="company-info"), below("h1")), "company_size": Rule((below("li", holds="Quy mô công ty"),), "all", joined=" ", without="quy mô")},
    "jobsgo": {"company_size": first(below("li", words="d-flex"), below("i", words="pb-heroicons-users"), after("span")), "company_industry": first(below("div", words="company-category"), below("span", words="company-category-list"), below("span"))},
}

# Over tables ---------------------------------------------------------------------

FIELDS = (
    "job_title company_title location experience compensation job_type work_mode level company_size company_industry job_category number_recruit education_level "
    "job_description job_requirement job_posted_at job_deadline company_url").split()


def page_values(page: str, rules: dict[str, Rule]) -> dict[str, str | None]:
    outline = Outline(page)
    return {name: rule.value(outline) for name, rule in rules.items()}


def fields_of(pages: DataFrame, rules: dict[str, dict[str, Rule]] = POSTING_RULES, url: str = "url", website: str = "website", html: str = "html") -> DataFrame:
    """job_url, website and FIELDS of each page, a row a row of `pages`.

    A field is null where its rule finds nothing; all are for null or empty pages
    and for sites without rules. Texts are trimmed, blank ones passed over.
    """
    import pyarrow as pa

    schema = ", ".join(f"{name} string" for name in ["job_url", "website", *FIELDS])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for link, site, page in zip(*batch.columns, strict=True):
                found = page_values(page.as_py() or "", rules.get(site.as_py(), {}))
                rows.append({"job_url": link.as_py(), "website": site.as_py(), **found})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([(n, pa.string()) for n in ["job_url", "website", *FIELDS]]))

    return pages.select(*[F.col(n).cast("string") for n in (url, website, html)]).mapInArrow(read, schema)


def company_values(companies: DataFrame) -> DataFrame:
    """company_url, company_title, company_size and company_industry of company pages (url, website, html).

    Of pages with one url the one whose website and text sort last counts; a null url is no company's.
    """
    last = companies.where("url is not null").groupBy("url").agg(F.max(F.struct("website", "html")).alias("page")).select("url", "page.website", "page.html")
    return fields_of(last, COMPANY_RULES).select(F.col("job_url").alias("company_url"), "company_title", "company_size", "company_industry")


def with_company(postings: DataFrame, values: DataFrame) -> DataFrame:
    """Postings with title, size and industry from `company_values` where their own page says nothing."""
    return detail_else_card(postings, values, "company_url", ["company_title", "company_size", "company_industry"])
