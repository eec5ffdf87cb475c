"""Fields of saved pages of seven sites, from markup as sites write it."""

import pytest

from vireo.sources import fields

PAGES = {
    "careerlink": """<html><head><script>var x = "<div>Kinh nghiệm</div><div>9</div>";</script></head><body>
      <h1 class="job-title mb-0">  Kỹ sư dữ liệu &amp; AI </h1><div class="company-info"><h5 class="company-name-title"><a href="/c"><span>Công ty A</span></a></h5></div>
      <div id="job-location"><a title="Hà Nội" href="#">Quận 1</a><a title="Huế">x</a></div>
      <div id="job-salary"><i></i><span class="text-primary bold">20 - 30 triệu</span></div>
      <div class="row"><div>Kinh nghiệm</div><div>2 năm</div></div><div class="row"><div>Loại công việc</div><div> Toàn thời gian</div></div>
      <div><div>Cấp bậc</div><div>Nhân viên</div></div><div><div>Học vấn</div><div>Đại học</div></div>
      <div><div>Ngành nghề</div><div><a><span>IT</span></a> / <a><span> Ngân hàng </span></a></div></div>
      <p><i class="cli-users"></i><span>25 - 99</span>
      <div id="section-job-description"><div class="rich-text-content"><p>Một<br>Hai<ul><li>Ba<li>Bốn</ul><style>p {}</style></div></div>
      <div id="section-job-skills"><h5>no</h5><div class="x rich-text-content">SQL <b>và</b> Spark</div></div>
      <div class="date-from"><span class="d-flex">Đăng</span><span class="d-flex"> 01-02-2026 </span></div><div id="job-date"><div class="day-expired">còn <b>10</b></div></div>""",
    "careerviet": """<section class="job-desc"><h1>Lập trình viên</h1><a href="/nha-tuyen-dung/b">B</a></section><div class="detail-box"><div class="map"><p><a>Đà Nẵng</a><a>Huế</a></p></div></div>
      <ul><li><strong><em></em>Kinh nghiệm</strong><p>1 - 2 Năm</p><li><strong>Lương</strong><p>Cạnh tranh</p></li><li><strong>Hình thức</strong><p>Nhân viên chính thức</p></li>
      <li><strong>Cấp bậc</strong><p>Trưởng nhóm</p></li><li><strong>Ngành nghề</strong><p> <a>CNTT</a>, <a>Viễn thông</a></p></li><li>Bằng cấp: <span>x</span> Đại học</li>
      <li><strong>Ngày cập nhật</strong><p>02/02/2026</p></li><li><strong>Hết hạn nộp</strong><p>03/03/2026</p></li></ul>
      <div class="d"><h2>Mô tả Công việc</h2><div><p>Viết</p><p>mã</p></div></div><div><h2>Yêu Cầu Công Việc</h2><div>Java</div></div>""",
    "joboko": """<h1 class="nw-company-hero__title"><a>Tester</a></h1><a class="nw-company-hero__text x">Cty C</a><div class="nw-company-hero__address"><a>Hà Nội</a>, <a>Huế</a></div>
      <div class="item-content">Thu nhập: <span class="fw-bold">10 triệu</span></div><div class="item-content">Kinh nghiệm <span class="fw-bold">1 năm</span></div>
      <div class="item-content">Loại hình <span class="fw-bold">Part</span></div><div class="item-content">Chức vụ <span class="fw-bold x">không</span><span class="fw-bold">Lead</span></div>
      <div><div class="nw-job-detail__heading"><span>Quy mô <b>công ty</b></span></div><div class="nw-job-detail__text">25</div><div class="nw-job-detail__heading">Ngày làm mới</div><p></p><div class="nw-job-detail__text">04/02/2026</div></div>
      <div class="text-left job-desc">Thử <i>phần mềm</i></div><div class="text-left job-requirement">Kiên nhẫn</div><em class="item-date" data-value="05/03/2026"></em>""",
    "timviec365": """<div class="boxTitleNameNtd"><h1>Kế toán</h1><a href="/x">Cty D</a></div><span class="dataNewReal y timeUpdate">06/02/2026</span><p class="txtSalaryNew valContentSalary">8 triệu</p>
      <div><p>Địa điểm</p><p>Huế</p></div><div><p>Kinh nghiệm</p><p>Không</p></div><div><p>Hình thức làm việc</p><p>Toàn</p></div><div><p>Chức vụ</p><p>NV</p></div><div><p>Số lượng cần tuyển</p><p>3</p></div><div><p>Bằng cấp</p><p>Cao đẳng</p></div>
      <div><p>Ngành nghề :</p><div><a>A</a><a>B</a></div></div><div><p>Lĩnh vực</p><div><a>L</a></div></div>
      <div class="itemInfoSpecific"><h2>Mô tả công việc</h2><div class="valInfoSpecific">Ghi sổ</div></div><div class="boxYeuCauKhac"><div class="valInfoSpecific w100">bỏ<p>Cẩn thận</p></div></div><p class="valHanNop">07/03/2026</p>""",
    "vieclam24h": """<h1>Bán hàng</h1><div class="flex flex-col gap-3 w"><a title="E"><div>Cty E</div></a><div><i class="svicon-users"></i><div>10 - 24</div></div></div>
      <div><div>Ngày đăng</div><div>08/02/2026</div></div><div><div>Mức lương</div><div class="text-14">5 triệu</div></div><div><div>Khu vực tuyển</div><p><a><span>Cần Thơ</span></a></p></div>
      <div><div>Yêu cầu kinh nghiệm</div><div class="text-14">Không</div></div><div><div>Yêu cầu bằng cấp</div><div class="text-14">THPT</div></div><div><div>Ngành nghề</div><div><a>Bán</a><a>Lẻ</a></div></div>
      <div><div>Hạn nộp hồ sơ:</div><div>09/03/2026</div></div><div><div>Cấp bậc</div><div>NV</div></div><div><div>Số lượng tuyển</div><div>7</div></div><div><div>Hình thức làm việc</div><div>Ca</div></div>
      <section><h2>Mô tả công việc</h2><div>Bán <b>sách</b></div><div>không</div><h2>Yêu cầu công việc</h2><div>Vui vẻ</div></section>""",
    "topcv": """<h1 class="job-detail__info--title"><i></i> DevOps <b>Senior</b></h1><a class="name x">Cty F</a><div><div class="job-detail__info--section-content-title">Địa điểm</div><div>Hà Nội</div></div>
      <div><div>Kinh nghiệm</div><div class="content-value"><b>5 năm</b></div></div><div><div>Mức lương</div><div class="value">3000 USD</div></div><div><h3>Thời gian làm việc</h3><div>T2 - T6</div></div>
      <div class="company-scale"><div class="company-value">500+</div></div><div class="company-title">Lĩnh vực:</div><div class="company-value">IT</div>
      <div><h3>Mô tả công việc</h3><div class="job-description__item--content">bỏ<p>Vận hành <b>cụm</b></p></div></div><h3>Yêu cầu ứng viên</h3><div class="job-description__item--content"><p>Linux</p></div><div class="job-detail__info--deadline-date">10/03/2026</div>""",
    "jobsgo": """<h1 class="job-title">BA</h1><h6 class="fw-semibold">Cty G</h6><span>Mức lương: <strong>15 triệu</strong></span><span>Địa điểm <strong>Hà Nội, <a>Huế</a></strong></span><span>Loại hình</span><strong>Full</strong>
      <div class="text-muted">Ngành nghề:</div><strong><a>IT</a><a>PM</a></strong><h3>Mô tả công việc</h3><div>Phân tích</div><h3>Yêu cầu công việc</h3><div>UML</div><div class="card-company"><a href="https://g/c">x</a></div>""",
}
WANT = {
    "careerlink": dict(job_title="Kỹ sư dữ liệu & AI", company_title="Công ty A", location="Hà Nội", experience="2 năm", compensation="20 - 30 triệu", job_type="Toàn thời gian", level="Nhân viên", company_size="25 - 99", company_industry="IT / Ngân hàng",
                       education_level="Đại học", job_description="Một Hai Ba Bốn", job_requirement="SQL và Spark", job_posted_at="01-02-2026", job_deadline="10"),
    "careerviet": dict(job_title="Lập trình viên", location="Đà Nẵng", experience="1 - 2 Năm", compensation="Cạnh tranh", job_type="Nhân viên chính thức", level="Trưởng nhóm", company_industry="CNTT", education_level="Đại học", job_description="Viết mã",
                       job_requirement="Java", job_posted_at="02/02/2026", job_deadline="03/03/2026", company_url="/nha-tuyen-dung/b"),
    "joboko": dict(job_title="Tester", company_title="Cty C", location="Hà Nội, Huế", experience="1 năm", compensation="10 triệu", job_type="Part", level="Lead", company_size="25", job_description="Thử phần mềm", job_requirement="Kiên nhẫn",
                   job_posted_at="04/02/2026", job_deadline="05/03/2026"),
    "timviec365": dict(job_title="Kế toán", company_title="Cty D", location="Huế", experience="Không", compensation="8 triệu", job_type="Toàn", level="NV", company_industry="A B", job_category="L", number_recruit="3", education_level="Cao đẳng",
                       job_description="Ghi sổ", job_requirement="Cẩn thận", job_posted_at="06/02/2026", job_deadline="07/03/2026"),
    "vieclam24h": dict(job_title="Bán hàng", company_title="Cty E", location="Cần Thơ", experience="Không", compensation="5 triệu", job_type="Ca", level="NV", company_size="10 - 24", company_industry="Bán Lẻ", number_recruit="7", education_level="THPT",
                       job_description="Bán sách", job_requirement="Vui vẻ", job_posted_at="08/02/2026", job_deadline="09/03/2026"),
    "topcv": dict(job_title="DevOps Senior", company_title="Cty F", location="Hà Nội", experience="5 năm", compensation="3000 USD", work_mode="T2 - T6", company_size="500+", company_industry="IT", job_description="Vận hành cụm", job_requirement="Linux", job_deadline="10/03/2026"),
    "jobsgo": dict(job_title="BA", company_title="Cty G", location="Hà Nội, Huế", compensation="15 triệu", job_type="Full", job_category="IT PM", job_description="Phân tích", job_requirement="UML", company_url="https://g/c"),
}


@pytest.mark.parametrize("site", PAGES)
def test_fields_of_a_page(site):
    got = fields.page_values(PAGES[site], fields.POSTING_RULES[site])
    assert {k: v for k, v in got.items() if v is not None} == WANT[site]


def test_fields_as_a_job(spark):
    rows = [(f"u/{s}", s, p, 1) for s, p in PAGES.items()] + [("u/joboko", "joboko", PAGES["joboko"], 2), (None, "topcv", None, 3), ("u", None, "<h1>x", 4), ("v", "unknown", "<h1>x", 5), ("w", "vieclam24h", "", 6)]
    got = fields.fields_of(spark.createDataFrame(rows, "url string, website string, html string, job_title int").repartition(3)).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["job_url", "website", *fields.FIELDS]
    by = {(r.job_url, r.website): {k: v for k, v in r.asDict().items() if v is not None and k in fields.FIELDS} for r in got}
    assert all(by[f"u/{s}", s] == WANT[s] for s in PAGES) and not any(by[k] for k in [(None, "topcv"), ("u", None), ("v", "unknown"), ("w", "vieclam24h")])
    assert sum(r.job_url == "u/joboko" for r in got) == 2


def test_company_pages(spark):
    viet = '<div class="company-info"><h1>Cty B</h1></div><ul><li>Quy mô công ty: <b>100 - 499</b> người</li></ul>'
    pages = spark.createDataFrame([("/nha-tuyen-dung/b", "careerviet", viet), ("/nha-tuyen-dung/b", "careerviet", ""), ("https://g/c", "jobsgo", '<li class="d-flex"><i class="pb-heroicons-users"></i><span>50</span>')], "url string, website string, html string")
    postings = fields.fields_of(spark.createDataFrame([(f"u/{s}", s, p) for s, p in PAGES.items()], "url string, website string, html string"))
    got = {r.website: (r.company_title, r.company_size, r.company_industry) for r in fields.with_company(postings, fields.company_values(pages)).collect()}
    assert got["careerviet"] == ("Cty B", "100 - 499 người", "CNTT") and got["jobsgo"] == ("Cty G", "50", None) and got["joboko"] == ("Cty C", "25", None) and len(got) == len(PAGES)


def test_outline_of_broken_markup():
    page = fields.Outline("</div><p>a<div>b<span>c</div>d<br/>e<table><tr><td>f<td>g<tr><td>h</table><ul><li>i<ul><li>j</ul><li>k</ul>")
    e = page.elements
    assert [x.tag for x in e[1:]] == "p div span br table tr td td tr td ul li ul li li".split()
    assert all(e[i].last >= i and e[e[i].parent].last >= e[i].last for i in range(1, len(e)))
    assert [e[i].parent for i in page.by_tag["td"]] == [page.by_tag["tr"][0]] * 2 + [page.by_tag["tr"][1]]
    assert "".join(page.pieces) == "abcdefghijk" and page.holds(page.by_tag["ul"][0], "ijk") and not page.holds(page.by_tag["table"][0], "hi")
    deep = fields.Outline("<div>" * 20_000 + "x")
    assert deep.holds(20_000, "x") and len(deep.elements) == 20_001
