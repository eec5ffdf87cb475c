"""Word lists and tables that results depend on, in order of precedence.

`Vocabulary` adds keywords of skills and further titles to them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values -----------------------------------------------------------------

PROVINCES = {
    "TP. Hồ Chí Minh": ["hồ chí minh", "tp. hồ chí minh", "tp hồ chí minh", "hcm", "tphcm", "hcmc", "sg", "sài gòn", "ho chi minh city", "ho chi minh", "bình dương", "binh duong", "bà rịa", "vũng tàu", "vung tau", "bà rịa - vũng tàu"],
    "TP. Hà Nội": ["hà nội", "hn", "tp. hà nội", "tp hà nội", "hanoi", "ha noi"],
    "TP. Hải Phòng": ["hải phòng", "tp. hải phòng", "tp hải phòng", "hai phong", "hải dương", "hai duong"],
    "TP. Đà Nẵng": ["đà nẵng", "đà nang", "tp. đà nẵng", "tp đà nẵng", "da nang", "da nang city", "quảng nam"],
    "TP. Cần Thơ": ["cần thơ", "tp. cần thơ", "tp cần thơ", "can tho", "sóc trăng", "hậu giang"],
    "TP. Huế": ["huế", "tp. huế", "tp huế", "hue", "thừa thiên huế"],
    "Bắc Ninh": ["bắc ninh", "bac ninh", "bắc giang"],
    "Hưng Yên": ["hưng yên", "hung yen", "thái bình"],
    "Lào Cai": ["lào cai", "lao cai", "yên bái"],
    "Ninh Bình": ["ninh bình", "hà nam", "nam định"],
    "Phú Thọ": ["phú thọ", "hòa bình", "vĩnh phúc", "vinh phuc"],
    "Thái Nguyên": ["thái nguyên", "thai nguyen", "bắc kạn", "bắc cạn"],
    "Tuyên Quang": ["tuyên quang", "hà giang"],
    "Quảng Ninh": ["quảng ninh", "quang ninh"],
    "Cao Bằng": ["cao bằng"], "Lạng Sơn": ["lạng sơn"], "Sơn La": ["sơn la"], "Điện Biên": ["điện biên"], "Lai Châu": ["lai châu"],
    "Thanh Hóa": ["thanh hóa", "thanh hoa"],
    "Nghệ An": ["nghệ an", "nghe an"], "Hà Tĩnh": ["hà tĩnh", "ha tinh"],
    "Quảng Bình": ["quảng bình", "quảng trị"], "Quảng Ngãi": ["quảng ngãi", "kon tum"],
    "Gia Lai": ["bình định", "gia lai"], "Đắk Lắk": ["đắk lắk", "dak lak", "phú yên"],
    "Khánh Hoà": ["khánh hòa", "khánh hoà", "khanh hoa", "ninh thuận", "nha trang"],
    "Lâm Đồng": ["lâm đồng", "lam dong", "đắk nông", "dak nong", "bình thuận", "đà lạt", "da lat"],
    "Đồng Nai": ["đồng nai", "dong nai", "bình phước"], "Đồng Tháp": ["đồng tháp", "tiền giang"],
    "Tây Ninh": ["tây ninh", "long an"], "Vĩnh Long": ["vĩnh long", "bến tre", "trà vinh"],
    "An Giang": ["an giang", "kiên giang", "kien giang", "phú quốc", "phu quoc"], "Cà Mau": ["cà mau", "bạc liêu"],
}
REGIONS = {
    "Bắc": ["TP. Hà Nội", "TP. Hải Phòng", "Bắc Ninh", "Hưng Yên", "Lào Cai", "Ninh Bình", "Phú Thọ", "Thái Nguyên", "Tuyên Quang", "Quảng Ninh", "Cao Bằng", "Lạng Sơn", "Sơn La", "Điện Biên", "Lai Châu"],
    "Trung": ["Thanh Hóa", "Nghệ An", "Hà Tĩnh", "Quảng Bình", "TP. Huế", "TP. Đà Nẵng", "Quảng Ngãi", "Gia Lai", "Đắk Lắk", "Khánh Hoà", "Lâm Đồng"],
    "Nam": ["TP. Hồ Chí Minh", "TP. Cần Thơ", "Đồng Nai", "Đồng Tháp", "Tây Ninh", "Vĩnh Long", "An Giang", "Cà Mau"],
}
OTHER_PLACE = "Khác"

NEGOTIABLE = [
    "thỏa thuận", "thoả thuận", "thương lượng", "cạnh tranh", "mới cập nhật", "negotiate", "negotiable", "competitive", "you'll love it", "hấp dẫn", "theo năng lực", "trao đổi thêm", "theo kinh nghiệm",
    "xem thêm", "lương cứng", "attractive", "based on", "market rate", "commensurate", "tbd", "t.b.d", "to be discussed", "to be confirmed", "sẽ thảo luận"]
#: Currency: pattern, to VND, least and most plausible monthly amount.
CURRENCIES = [
    ("USD", r"\$|usd|\bđô\b|dollar", 25_500.0, 50, 50_000),
    ("VND", r"vnđ|vnd|đ(?!ồng)|đồng|triệu|triêu|nghìn\s*đ|ngàn\s*đ", 1.0, 500_000, 500_000_000),
    ("JPY", r"\bjpy\b|¥|yen", 168.0, 50_000, 5_000_000),
    ("EUR", r"\beur\b|€|euro", 27_500.0, 500, 30_000),
    ("SGD", r"\bsgd\b|s\$", 19_000.0, 500, 30_000),
    ("GBP", r"\bgbp\b|£|pound", 32_000.0, 500, 30_000),
    ("AUD", r"\baud\b|a\$", 16_500.0, 500, 30_000),
    ("CAD", r"\bcad\b|ca\$", 18_500.0, 500, 30_000),
    ("KRW", r"\bkrw\b|₩|won", 18.5, 500_000, 50_000_000),
    ("CNY", r"\bcny\b|rmb|yuan", 3_500.0, 1_000, 200_000),
    ("THB", r"\bthb\b|฿|baht", 700.0, 5_000, 500_000),
]
YEARLY = r"/\s*year|per\s+year|/\s*yr|/\s*năm|/\s*annum|annually|hàng\s*năm|mỗi\s*năm|\bpa\b|\bp\.a\b"
MONTHLY = r"/\s*month|per\s+month|/\s*tháng|/\s*mo\b|hàng\s*tháng|mỗi\s*tháng"
HOURLY = r"/\s*hour|per\s+hour|/\s*hr\b|/\s*giờ"
PER_TASK = r"per\s*task|/\s*task|by\s*task"
FROM_WORDS = ["từ", "from", "trên", "hơn", "minimum", "tối thiểu", "at least", "ít nhất", "starting", "bắt đầu từ"]
UP_TO_WORDS = ["đến", "tới", "up to", "upto", "up-to", "dưới", "maximum", "tối đa", "không quá", "lên đến"]
SALARY_BINS = [(0, 3_000_000, "Dưới 3 triệu"), (3_000_000, 10_000_000, "3 – 10 triệu"), (10_000_000, 15_000_000, "10 – 15 triệu"), (15_000_000, 25_000_000, "15 – 25 triệu"), (25_000_000, 35_000_000, "25 – 35 triệu"), (35_000_000, 50_000_000, "35 – 50 triệu"), (50_000_000, None, "Hơn 50 triệu")]

NO_EXPERIENCE = [
    "không yêu cầu", "no experience", "chưa có kinh nghiệm", "fresher", "không cần kinh nghiệm", "sinh viên mới ra trường", "chưa có", "không cần", "no experience required", "sinh viên năm cuối", "mới ra trường", "entry level"]
EXPERIENCE_SENTENCE = (
    r"tối thiểu|yêu cầu|cần có|có ít nhất|ít nhất|kinh nghiệm làm việc|kinh nghiệm tối thiểu|năm kinh nghiệm|năm kn|năm kinh nghiêm|tháng kinh nghiệm|years? of experience|years? experience|year experience|yrs? of experience"
    r"|minimum.*experience|at least.*experience|required.*experience|experience required|\d+\+\s*years?|\d+\s+to\s+\d+\s+years?|\d+[-–]\d+\s+years?")
EXPERIENCE_OVER = ["trên", "hơn", "over", "minimum", "tối thiểu", "at least", "ít nhất"]
EXPERIENCE_UNDER = ["dưới", "less than", "maximum", "tối đa", "up to"]
EXPERIENCE_BINS = [(0.0, 0.0, "Không yêu cầu"), (0.0, 1.0, "Dưới 1 năm"), (1.0, 3.0, "1 – 3 năm"), (3.0, 5.0, "3 – 5 năm"), (5.0, None, "Trên 5 năm")]

#: From the highest level down: the first found wins. Entries with a backslash are patterns.
LEVELS = [
    ("Manager+", ["manager", "project manager", "quản lý", "trưởng phòng", "head of", "trưởng bộ phận", "director", "giám đốc", r"\bvp\b", "vice president", "phó giám đốc", "ceo", "cto", "cfo", "coo", "cmo", "c-level"]),
    ("Lead", ["tech lead", "team lead", "trưởng nhóm", "lead developer", "lead engineer"]),
    ("Senior", ["senior", r"sr\."]),
    ("Middle", ["mid-level", "mid level", "middle", "intermediate"]),
    ("Junior", ["junior", r"jr\."]),
    ("Fresher", ["fresher", "fresh grad", "mới tốt nghiệp", "entry level", "entry-level"]),
    ("Intern", ["intern", "thực tập", "internship", "trainee"]),
]
LEVEL_YEARS = [(0.0, 0.5, "Intern"), (0.5, 1.5, "Fresher"), (1.5, 3.0, "Junior"), (3.0, 5.0, "Middle"), (5.0, 8.0, "Senior"), (8.0, 12.0, "Lead"), (12.0, None, "Manager+")]

EDUCATION = [
    ("Tiến sĩ", ["tiến sĩ", "phd", "doctorate"]), ("Thạc sĩ", ["thạc sĩ", "master", "mba", "m.s.", "m.a."]),
    ("Đại học", ["đại học", "cử nhân", "kỹ sư", "bachelor", "university", "college"]), ("Cao đẳng", ["cao đẳng", "associate"]),
    ("Trung cấp", ["trung cấp", "vocational"]), ("THCS/THPT", ["thpt", "thcs", "trung học", "high school"])]
NO_EDUCATION = "Không yêu cầu"

INDUSTRIES = [
    ("Công nghệ", "Phát triển phần mềm và Ứng dụng", ["phần mềm", "lập trình", "backend", "frontend", "fullstack", "web developer", "mobile developer", "app developer", "software engineer", "api", "microservices", "saas", "erp", "crm"]),
    ("Công nghệ", "Dữ liệu và Trí tuệ nhân tạo", ["data analyst", "data engineer", "data scientist", "bi", "business intelligence", "etl", "data warehouse", "dashboard", "power bi", "tableau", "sql", "big data", "machine learning", "ai", "trí tuệ nhân tạo", "nlp", "llm"]),
    ("Công nghệ", "An ninh mạng và Hạ tầng hệ thống", ["an ninh mạng", "bảo mật", "cyber security", "information security", "soc analyst", "penetration testing", "network", "telecom", "viễn thông", "it infrastructure", "hạ tầng mạng"]),
    ("Công nghệ", "Điện tử nhúng và Hệ thống điều khiển", ["embedded", "nhúng", "firmware", "iot", "vi mạch", "plc", "scada", "tự động hóa", "robotics"]),
    ("Công nghệ", "Thiết kế kỹ thuật số và Trải nghiệm người dùng", ["ui", "ux", "designer", "graphic designer", "figma", "photoshop", "illustrator", "thiết kế đồ họa"]),
    ("Tài chính và Kinh doanh", "Dịch vụ Tài chính và Ngân hàng", ["ngân hàng", "banking", "finance", "tài chính", "đầu tư", "chứng khoán", "quản lý quỹ", "asset management", "forex", "tín dụng"]),
    ("Tài chính và Kinh doanh", "Kế toán và Kiểm toán", ["kế toán", "kiểm toán", "thuế", "accounting", "audit", "tax", "báo cáo tài chính"]),
    ("Tài chính và Kinh doanh", "Tiếp thị và Truyền thông", ["marketing", "digital marketing", "seo", "sem", "content", "branding", "pr", "quảng cáo", "social media", "tổ chức sự kiện"]),
    ("Tài chính và Kinh doanh", "Phát triển kinh doanh và Bán hàng", ["bán hàng", "sales", "kinh doanh", "business development", "account manager", "chăm sóc khách hàng"]),
    ("Sản xuất và Công nghiệp", "Kỹ thuật sản xuất và Năng lượng", ["sản xuất", "manufacturing", "cơ khí", "điện tử", "ô tô", "điện lực", "năng lượng", "dầu khí", "oil & gas", "khai khoáng", "qa/qc"]),
    ("Xây dựng và Bất động sản", "Xây dựng và Kiến trúc", ["xây dựng", "construction", "kiến trúc", "thi công", "nội thất", "bất động sản", "real estate", "môi giới"]),
    ("Thương mại và Dịch vụ", "Bán lẻ và Thương mại điện tử", ["bán lẻ", "retail", "ecommerce", "thương mại điện tử", "fmcg", "phân phối", "siêu thị"]),
    ("Thương mại và Dịch vụ", "Du lịch và Dịch vụ lưu trú", ["nhà hàng", "khách sạn", "du lịch", "hospitality", "f&b", "spa", "thẩm mỹ", "làm đẹp"]),
    ("Vận tải và Logistics", "Quản trị chuỗi cung ứng và Vận tải", ["logistics", "vận tải", "supply chain", "kho bãi", "xuất nhập khẩu", "freight", "giao hàng"]),
    ("Công và Xã hội", "Y tế và Dược phẩm", ["y tế", "bệnh viện", "dược", "pharma", "healthcare", "medical", "thiết bị y tế"]),
    ("Công và Xã hội", "Giáo dục và Đào tạo", ["giáo dục", "đào tạo", "trường học", "education", "teaching", "giảng dạy"]),
    ("Công và Xã hội", "Quản trị nhân sự và Pháp lý", ["nhân sự", "hr", "human resources", "hành chính", "administration", "luật", "pháp lý", "legal"]),
]
UNKNOWN_INDUSTRY = "Không xác định"

COMPANY_TYPES = [
    ("TNHH", r"\btrách\s+nhiệm\s+hữu\s+hạn\b|\btnhh\b"), ("Cổ phần", r"\bcổ\s+phần\b|\bjsc\b|\bjoint[\s\-]stock\b|\bctcp\b"), ("Tập đoàn", r"\btập\s+đoàn\b"),
    ("Hợp tác xã", r"\bhợp\s+tác\s+xã\b|\bhtx\b"), ("Tư nhân", r"\bdoanh\s+nghiệp\s+tư\s+nhân\b|\bdntn\b"), ("Pte Ltd", r"\bpte\.?\s*ltd\.?\b"), ("LLC", r"\bllc\b"),
    ("Ltd", r"\bltd\.?\b|\blimited\b|\bco\.?\s*,?\s*ltd\.?\b"), ("Inc", r"\binc\.?\b|\bincorporated\b"), ("Corporation", r"\bcorporation\b|\bcorp\.?\b"), ("Plc", r"\bplc\b"), ("GmbH", r"\bgmbh\b"),
    ("Holding", r"\bholdings?\b"), ("Ngân hàng", r"\bngân\s+hàng\b|\bbank\b"), ("Trường/Viện", r"\btrường\b|\bđại\s+học\b|\bhọc\s+viện\b|\bviện\b"), ("Trung tâm", r"\btrung\s+tâm\b"), ("Chi nhánh", r"\bchi\s+nhánh\b"),
    ("Confidential", r"client\b|confidential|employer\s+brand|ẩn\s+danh"),
]
COMPANY_FORMS = [
    (r"\bTNHH\s+MTV\b", "Công ty TNHH MTV"), (r"\bCông\s+ty\s+TNHH\s+Một\s+thành\s+viên\b", "Công ty TNHH MTV"), (r"\bCty\s+TNHH\s+MTV\b", "Công ty TNHH MTV"), (r"\bCty\s+TNHH\b", "Công ty TNHH"),
    (r"\bCông\s+ty\s+Trách\s+nhiệm\s+hữu\s+hạn\b", "Công ty TNHH"), (r"\bCTCP\b", "Công ty Cổ phần"), (r"\bCty\s+CP\b", "Công ty Cổ phần"), (r"\bCông\s+ty\s+CP\b", "Công ty Cổ phần"),
    (r"\bCty\s+Cổ\s+phần\b", "Công ty Cổ phần"), (r"\bJSC\b", "Công ty Cổ phần"), (r"\bDNTN\b", "Doanh nghiệp Tư nhân"), (r"\bDoanh\s+nghiệp\s+TN\b", "Doanh nghiệp Tư nhân"), (r"\bTĐ\b", "Tập đoàn"),
]
CONFIDENTIAL = r"(?:careerlink|vietnamworks|topcv|itviec|linkedin|jobstreet|timviecnhanh)['\s]*(?:client|'s\s+client)|confidential\s+(?:company|employer)|employer\s+brand|ẩn\s+danh"
LEGAL_WORDS = (
    r"\b(?:tổng\s+công\s+ty|trách\s+nhiệm\s+hữu\s+hạn\s+một\s+thành\s+viên|trách\s+nhiệm\s+hữu\s+hạn\s+mtv|trách\s+nhiệm\s+hữu\s+hạn|một\s+thành\s+viên|ngân\s+hàng\s+thương\s+mại\s+cổ\s+phần|ngân\s+hàng\s+tmcp|ngân\s+hàng"
    r"|hợp\s+tác\s+xã|cổ\s+phần|tập\s+đoàn|chi\s+nhánh|văn\s+phòng\s+đại\s+diện|ctcp|tnhh\s+mtv|tnhh\s+1tv|tnhh|joint[\s\-]stock\s+company|joint[\s\-]stock|jsc|llc|ltd\.?|inc\.?|corp\.?|corporation|co\.?\s*,?\s*ltd\.?"
    r"|pte\.?\s*ltd\.?|plc|gmbh|ag|group|holdings?|ventures?|services?|trading|solutions?|systems?|technolog(?:y|ies)|international|global|việt\s*nam|vietnam|viet\s*nam|cn)\b")
PLACE_WORDS = r"\s*\b(?:capital|city|metropolitan|metropolis|metro|province|municipality|region|urban area|greater|district|thủ đô|thành phố|tỉnh|tp\.?)\b\s*"

WORK_TYPES = [
    ("Freelance", ["freelance", "freelancer", "tự do", "cộng tác viên", "ctv", "project base", "theo dự án", "thời vụ"]),
    ("Part-time", ["part time", "part-time", "bán thời gian", "ca gãy", "4 tiếng", "parttime", "internship", "thực tập", "trainee"]),
    ("Full-time", ["full time", "full-time", "toàn thời gian", "chính thức", "hành chính", "hợp đồng chính thức"])]
WORK_MODES = [
    ("Hybrid", ["hybrid", "linh hoạt", "xen kẽ", "flexible", "kết hợp", "mix", "bán từ xa", "semi-remote", "ngày lên văn phòng", "days at office"]),
    ("Remote", ["remote", "từ xa", "wfh", "work from home", "tại nhà", "không cần lên văn phòng", "làm việc tại nhà", "làm từ xa", "work remotely"]),
    ("Onsite", ["onsite", "tại văn phòng", "office", "trực tiếp", "offline", "văn phòng", "làm việc tại văn phòng"])]

MAJORS = [
    ("Công nghệ thông tin", ["công nghệ thông tin", "khoa học máy tính", "computer science", "kỹ thuật phần mềm", "software engineering", "hệ thống thông tin"]),
    ("Kỹ thuật điện - điện tử", ["điện", "điện tử", "viễn thông", "tự động hóa", "cơ điện tử"]), ("Cơ khí - Chế tạo", ["cơ khí", "chế tạo máy", "kỹ thuật cơ khí", "vật liệu"]),
    ("Kinh tế - Tài chính", ["kinh tế", "tài chính", "ngân hàng", "kế toán", "kiểm toán", "quản trị kinh doanh", "mba", "thương mại"]),
    ("Marketing - Truyền thông", ["marketing", "truyền thông", "báo chí", "quan hệ công chúng"]), ("Thiết kế", ["thiết kế", "mỹ thuật", "kiến trúc", "graphic", "ui/ux"]),
    ("Khoa học tự nhiên", ["toán", "vật lý", "hóa học", "sinh học", "thống kê"]), ("Y - Dược", ["y khoa", "dược", "điều dưỡng", "y tế công cộng"]), ("Luật", ["luật", "pháp lý", "law"]),
    ("Ngoại ngữ", ["ngoại ngữ", "tiếng anh", "tiếng nhật", "tiếng trung", "tiếng hàn", "ngôn ngữ học", "biên phiên dịch"]), ("Logistics - Quản lý chuỗi cung ứng", ["logistics", "xuất nhập khẩu", "quản lý chuỗi cung ứng"])]
CERTIFICATES = [
    "aws certified", "aws solutions architect", "aws developer", "aws sysops", "aws cloud practitioner", "azure certified", "az-900", "az-104", "az-204", "az-305", "gcp certified", "google cloud professional", "cissp", "cism", "cisa", "ceh", "oscp",
    "comptia security+", "comptia network+", "comptia a+", "ccna", "ccnp", "ccsp", "pmp", "prince2", "pmi-acp", "scrum master", "csm", "psm", "safe", "kanban", "itil", "cobit", "google data analytics", "ibm data science", "databricks",
    "tensorflow developer", "pytorch", "oracle certified", "java certified", "oca", "ocp", "microsoft certified", "mcsa", "mcse", "mcsd", "mta", "red hat certified", "rhcsa", "rhce", "linux foundation", "lfcs", "ckad", "cka", "six sigma", "iso 9001",
    "iso 27001", "toeic", "ielts", "toefl", "toefl ibt", "jlpt", "n1", "n2", "n3", "n4", "n5", "hsk", "hsk1", "hsk2", "hsk3", "hsk4", "hsk5", "hsk6", "topik", "topik i", "topik ii", "delf", "dalf"]
LANGUAGE_CERTIFICATES = {
    "Tiếng Anh": ["toeic", "ielts", "toefl", "toefl ibt"], "Tiếng Nhật": ["jlpt", "n1", "n2", "n3", "n4", "n5"], "Tiếng Trung": ["hsk", "hsk1", "hsk2", "hsk3", "hsk4", "hsk5", "hsk6"],
    "Tiếng Hàn": ["topik", "topik i", "topik ii"], "Tiếng Pháp": ["delf", "dalf"]}
SOFT_SKILLS = [
    ("Giao tiếp", ["giao tiếp", "communication", "trình bày", "thuyết trình", "presentation"]), ("Lãnh đạo", ["lãnh đạo", "leadership", "dẫn dắt", "quản lý nhóm", "team lead"]), ("Thương lượng", ["thương lượng", "đàm phán", "negotiation"]),
    ("Giải quyết vấn đề", ["giải quyết vấn đề", "problem solving", "xử lý tình huống"]), ("Tư duy phản biện", ["phản biện", "critical thinking", "tư duy logic", "analytical thinking"]), ("Sáng tạo", ["sáng tạo", "creative", "innovation"]),
    ("Quản lý thời gian", ["quản lý thời gian", "time management", "sắp xếp công việc"]), ("Làm việc nhóm", ["làm việc nhóm", "teamwork", "team work", "hòa đồng", "collaboration"]),
    ("Chịu áp lực", ["chịu được áp lực", "work under pressure", "áp lực cao", "high pressure"]), ("Tự học", ["tự học", "self-learning", "thích nghi", "ham học hỏi", "continuous learning"])]
#: Keywords of each skill, besides its own name.
SKILL_WORDS = {
    "Python": ["python"], "Java": ["java ", "java,"], "Go/Golang": ["golang", "go lang"], "JavaScript": ["javascript", "js ", "js,", "js."], "TypeScript": ["typescript"], "C++": ["c++"], "C#": ["c#", ".net", "dotnet", "asp.net"],
    "PHP": ["php", "laravel", "symfony"], "Ruby": ["ruby", "rails"], "Swift": ["swift"], "Kotlin": ["kotlin"], "Dart/Flutter": ["dart", "flutter"],
    "SQL": ["sql", "mysql", "postgresql", "postgres", "sql server", "mssql", "nosql", "mongodb", "redis", "elasticsearch", "cassandra"], "HTML/CSS": ["html", "css", "sass", "scss", "tailwind"], "Rust": ["rust"], "Scala": ["scala"],
    "Bash/Shell": ["bash", "shell script", "linux", "unix"], "VBA": ["vba", "excel macro"], "R": ["r lang", "r programming"], "MATLAB": ["matlab"], "C/C++": ["c/c++", "c lang"],
    "React": ["react", "reactjs", "react.js", "react native", "next.js", "nextjs"], "Angular": ["angular", "angularjs"], "Vue": ["vue", "vuejs", "nuxt"], "NodeJS": ["node", "nodejs", "node.js", "express.js", "nestjs"],
    "Spring": ["spring boot", "spring mvc", "spring cloud"], "Django/Flask": ["django", "flask", "fastapi"], "AWS": ["aws", "amazon web services", "ec2", "s3", "lambda", "eks", "ecs"], "Azure": ["azure", "microsoft azure"],
    "GCP": ["gcp", "google cloud", "bigquery", "cloud run"], "Docker": ["docker", "dockerfile", "docker compose"], "Kubernetes": ["k8s", "kubernetes", "helm"], "Terraform": ["terraform", "infrastructure as code", "iac"],
    "CI/CD": ["ci/cd", "jenkins", "github actions", "gitlab ci", "circleci", "argocd"], "Git": ["git", "github", "gitlab", "bitbucket", "svn"],
    "Excel": ["excel", "spreadsheet", "google sheet", "google sheets", "vlookup", "pivot table"], "Power BI": ["power bi", "powerbi", "dax", "power query"], "Tableau": ["tableau"],
    "Looker": ["looker", "google data studio", "looker studio"], "Qlik": ["qlik", "qlikview", "qliksense"], "SAS/SPSS": ["sas", "spss"], "Apache Spark": ["spark", "apache spark", "pyspark"], "Kafka": ["kafka", "apache kafka"],
    "Airflow": ["airflow", "apache airflow"], "TensorFlow": ["tensorflow", "tf", "tensorflow 2", "tf2"], "PyTorch": ["pytorch", "torch"], "Scikit-learn": ["scikit-learn", "sklearn"], "LangChain": ["langchain"],
    "LLM/RAG": ["llm", "rag", "retrieval augmented", "vector database", "vector db", "prompt engineering", "few-shot", "chain-of-thought", "cot", "in-context learning", "context window"],
    "Generative AI": ["generative ai", "gen ai", "genai", "stable diffusion", "diffusion model", "midjourney", "dall-e", "imagen", "text-to-image", "text to image"],
    "OpenAI API": ["openai", "gpt-4", "gpt-3", "chatgpt api", "whisper", "dall-e", "openai api"],
    "Hugging Face": ["hugging face", "huggingface", "transformers library", "bert", "roberta", "t5", "gpt2", "llama", "mistral", "falcon", "gemma"],
    "Computer Vision": ["computer vision", "cv ", "object detection", "image classification", "image segmentation", "yolo", "yolov", "resnet", "vgg", "efficientnet", "mediapipe", "opencv", "open-cv"],
    "NLP": ["nlp", "natural language processing", "text classification", "ner", "named entity", "sentiment analysis", "information extraction", "question answering", "summarization", "word embedding", "word2vec", "fasttext", "spacy", "nltk"],
    "MLOps": ["mlops", "ml pipeline", "model serving", "model deployment", "model monitoring", "feature store", "mlflow", "kubeflow", "bentoml", "seldon", "triton inference", "ray serve", "sagemaker", "vertex ai", "azure ml", "weight & biases", "wandb", "dvc", "data version control"],
    "Deep Learning": ["deep learning", "neural network", "cnn", "convolutional neural", "rnn", "lstm", "transformer", "attention mechanism", "self-attention", "encoder decoder", "gan", "generative adversarial", "vae", "variational autoencoder", "graph neural", "gnn", "reinforcement learning", "rl ", "drl", "ppo", "dqn"],
    "Data Science": ["data science", "exploratory data analysis", "eda", "feature engineering", "feature selection", "model evaluation", "cross-validation", "hyperparameter tuning", "a/b testing", "statistical modeling", "regression", "classification", "clustering", "anomaly detection", "time series", "forecasting"],
    "Vector DB": ["vector database", "vector db", "pinecone", "weaviate", "qdrant", "milvus", "chroma", "faiss", "pgvector", "embedding"],
    "AutoML": ["automl", "auto ml", "auto-sklearn", "h2o.ai", "pycaret", "tpot", "optuna", "hyperopt", "ray tune"], "Jira/Confluence": ["jira", "confluence", "atlassian"], "Trello/Asana": ["trello", "asana", "monday.com", "notion"],
    "Office": ["word", "powerpoint", "ms office", "tin học văn phòng", "google workspace"], "Design Tool": ["figma", "photoshop", "adobe xd", "sketch", "illustrator", "after effects", "canva"]}
HARD_SKILLS = list(SKILL_WORDS)

TITLES = [
    ("Project Manager", ["project manager", "pmo", "quản lý dự án", "điều phối dự án", "quản trị dự án"]), ("Project Leader", ["project leader", "trưởng dự án"]),
    ("IT Manager", ["it manager", "trưởng phòng it", "giám đốc công nghệ", "cto", "cio", "trưởng bộ phận it", "trưởng phòng công nghệ", "it section manager"]), ("Tech Lead", ["tech lead", "technical lead", "trưởng nhóm kỹ thuật", "team lead"]),
    ("IT Consultant", ["it consultant", "tư vấn giải pháp", "tư vấn công nghệ", "tư vấn kỹ thuật", "triển khai phần mềm", "technical consultant", "giải pháp phần mềm", "solution consultant", "presales consultant"]),
    ("Product Owner", ["product owner", "quản lý sản phẩm", "giám đốc sản phẩm", "phát triển sản phẩm"]), ("Product Manager", ["product manager", "quản trị sản phẩm", "product lead"]), ("Product Executive", ["product executive", "chuyên viên sản phẩm"]),
    ("Business Analyst", ["business analyst", "phân tích nghiệp vụ", "phân tích kinh doanh", "business data analyst"]), ("Full-stack Developer", ["fullstack", "full-stack", "full stack"]),
    ("Back-end Developer", ["backend", "back-end", "back end", "python developer", "java developer", "node developer", "api developer", "software engineer", "developer", "it developer"]),
    ("Front-end Developer", ["frontend", "front-end", "front end", "web developer"]), ("Mobile Developer", ["mobile", "android", "ios", "flutter", "react native", "swift", "kotlin", "xamarin"]), ("Game Developer", ["game developer", "unity", "unreal"]),
    ("Embedded Engineer", ["embedded", "nhúng", "firmware", "iot", "vi mạch", "plc", "scada", "automation", "tự động hóa"]), ("Tester", ["tester", "kiểm thử", "manual test", "test engineer", "qa engineer", "automation test"]),
    ("QA - QC", ["qa", "qc", "quality assurance", "quality control", "pqa", "đảm bảo chất lượng"]), ("DevOps/DevSecOps", ["devops", "sre", "devsecops", "ci/cd", "site reliability", "mlops", "scrum master"]),
    ("Cloud Engineer", ["cloud engineer", "aws engineer", "azure engineer", "gcp engineer", "kỹ sư đám mây", "cloud architect"]),
    ("System Engineer", ["system engineer", "brse", "network engineer", "kỹ sư mạng", "an ninh mạng", "security engineer", "bảo mật", "hạ tầng", "infrastructure engineer", "triển khai hệ thống"]),
    ("System Admin", ["system admin", "sysadmin", "quản trị hệ thống", "it administrator"]), ("Data Engineer", ["data engineer", "kỹ sư dữ liệu", "kĩ sư dữ liệu", "big data", "etl engineer", "data pipeline"]),
    ("Data Analyst", ["data analyst", "phân tích dữ liệu", "chuyên viên phân tích dữ liệu", "anlatics", "analytics"]), ("Data Scientist", ["data scientist", "khoa học dữ liệu", "data science"]),
    ("BI Analyst", ["business intelligence", "bi analyst", "bi executive", "bi developer"]), ("Database Engineer", ["dba", "database", "cơ sở dữ liệu", "sql developer", "quản trị csdl", "quản lý dữ liệu", "database administrator"]),
    ("AI Engineer", ["ai engineer", "trí tuệ nhân tạo", "machine learning", "deep learning", "llm", "generative ai", "gen ai", "computer vision", "nlp", "ml engineer", "ai researcher", "research engineer", "applied scientist", "mlops engineer", "prompt engineer", "rag engineer"]),
    ("Blockchain Engineer", ["blockchain", "smart contract", "web3", "solidity", "nft", "defi", "crypto"]), ("Solution Architect", ["solution architect", "kiến trúc sư", "kiến trúc hệ thống", "enterprise architect", "triển khai giải pháp", "chief architect", "solution designer"]),
    ("Designer", ["ui/ux", "ux/ui", "ui designer", "ux designer", "ux researcher", "product designer", "game designer", "game design", "figma", "adobe xd", "sketch", "interaction design", "design system"]),
    ("ERP/CRM Engineer", ["erp", "sap", "odoo", "salesforce", "crm developer", "microsoft dynamics", "servicenow"]),
    ("IT Support", ["it support", "helpdesk", "hỗ trợ kỹ thuật", "nhân viên kỹ thuật", "nhân viên vận hành", "chuyên viên vận hành hệ thống", "chuyên viên hỗ trợ kỹ thuật", "kỹ thuật máy tính", "sửa chữa", "lắp ráp", "kỹ thuật viên", "it phần cứng", "it helpdesk", "nhân viên it", "chuyên viên it", "it officer", "it executive", "technology services", "techinical architect"]),
    ("IT Sales", ["kinh doanh", "sale", "sales", "bán hàng", "account manager", "business development", "bd", "telesales", "sales executive", "solution sales", "project sales", "sales engineer", "pre sales", "presales"]),
]
TITLE_CATEGORIES = {
    "Management & Consulting": ["Project Manager", "Project Leader", "IT Manager", "Tech Lead", "IT Consultant"], "Product Management": ["Product Owner", "Product Manager", "Product Executive", "Business Analyst"],
    "Software Development": ["Full-stack Developer", "Back-end Developer", "Front-end Developer", "Mobile Developer", "Game Developer", "Embedded Engineer"], "Testing": ["Tester", "QA - QC"],
    "Cloud & Infrastructure": ["DevOps/DevSecOps", "Cloud Engineer", "System Engineer", "System Admin"], "Data Analytics": ["Data Engineer", "Data Analyst", "Data Scientist", "BI Analyst", "Database Engineer"],
    "AI & Blockchain": ["AI Engineer", "Blockchain Engineer"], "Designing": ["Designer"], "Helpdesk": ["IT Support"], "IT - Khác": ["ERP/CRM Engineer", "Solution Architect", "IT Sales"]}
ROLES = [
    ("dev", ["developer", "engineer", "lập trình", "programmer", "coding", "software"]), ("analyst", ["analyst", "analysis", "phân tích"]), ("qa", ["tester", "testing", "kiểm thử", "qa", "qc"]),
    ("infra", ["devops", "sre", "cloud", "system", "network", "admin"]), ("mgr", ["manager", "director", "head", "lead", "cto", "ceo", "trưởng", "giám đốc"]), ("support", ["support", "helpdesk", "hỗ trợ"])]
DOMAINS = [
    ("fe", ["react", "vue", "angular", "frontend", "front-end", "html", "css", "nextjs"]), ("be", ["python", "java", "golang", "node", "php", "backend", "back-end", "api", "django", "spring", "cobol", ".net", "ruby", "kotlin"]),
    ("mob", ["android", "ios", "flutter", "react native", "swift"]), ("data", ["sql", "etl", "pipeline", "spark", "kafka", "airflow", "power bi", "tableau"]), ("ai", ["machine learning", "deep learning", "llm", "nlp", "pytorch", "tensorflow", "ai "]),
    ("fs", ["fullstack", "full-stack", "full stack"])]
ROLE_DOMAIN_TITLES = {
    ("dev", "fe"): "Front-end Developer", ("dev", "be"): "Back-end Developer", ("dev", "mob"): "Mobile Developer", ("dev", "fs"): "Full-stack Developer", ("dev", "ai"): "AI Engineer", ("dev", "data"): "Data Engineer",
    ("analyst", "data"): "Data Analyst", ("analyst", "ai"): "Data Scientist"}
IT_SIGNALS = [
    "phần mềm", "lập trình", "kỹ thuật phần mềm", "công nghệ thông tin", "hệ thống", "mạng máy tính", "an ninh mạng", "bảo mật", "it ", " it,", "etl", "elt", "data", "cloud", "devops", "sre", "ci/cd", "api", "microservice", "blockchain", "web3",
    "embedded", "firmware", "iot", "plc", "scada", "sap", "erp", "odoo", "salesforce", "figma", "ui/ux", "power bi", "tableau", "looker", "bigquery", "software", "developer", "engineer", "programmer", "coder", "ai ", "machine learning", "deep learning",
    "ml ", "backend", "front end", "frontend", "fullstack", "full stack", "mobile", "android", "ios", "database", "dba", "network", "system admin", "sysadmin", "security", "cyber", "infosec", "architect", "qa ", "qc ", "tester", "ux", "scrum", "agile",
    "product manager", "product owner", "technical"]
TITLE_NOISE = [
    r"^(?:\[[^\]]*\]|\([^)]*\))\s*", r"\s*(?:\[[^\]]*\]|\([^)]*\))\s*$", r"\btuyển\s*(gấp|dụng)?\b", r"\bgấp\b", r"\bremote\b", r"\bfull[\s\-]?time\b", r"\bpart[\s\-]?time\b", r"\bhybrid\b", r"\bonsite\b", r"\bwork\s+from\s+home\b", r"\bwfh\b",
    r"\bnhiều\s+vị\s+trí\b", r"\b\d+\s+vị\s+trí\b", r"\b\d+\s+slots?\b", r"\bslot\b", r"\bnhiều\s+ưu\s+đãi\b", r"\bưu\s+đãi\s+hấp\s+dẫn\b", r"\blương\s+\d[\d\s\-–triệumk\.]+", r"\bsalary\s+upto\b[^,;]*", r"\bsalary\s+up\s+to\b[^,;]*",
    r"\s*[-–]\s*(?:làm việc\s+)?tại\s+[\w\s]{2,30}$"]
HEADCOUNT_MANY = ["nhiều", "số lượng lớn", "vô hạn", "không giới hạn"]
HEADCOUNT_TITLES = [r"tuyển\s+(\d+)", r"(\d+)\s+vị trí", r"(\d+)\s+nhân sự", r"(\d+)\s+nhân viên", r"(\d+)\s+người", r"(\d+)\s+slot", r"(\d+)\s+kỹ sư", r"(\d+)\s+chuyên viên", r"số lượng\s*[:\-]?\s*(\d+)"]

#: What follows an amount by the API's period, and its text of pay without amounts.
API_PERIODS = {1: "/tháng", 2: "/năm"}
API_NO_SALARY = "Thỏa thuận"
API_JOB_TYPE = {"1": "Toàn thời gian", "2": "Bán thời gian", "3": "Hợp đồng", "4": "Thực tập", "5": "Tạm thời"}
API_EDUCATION = {"0": "Bất kỳ", "2": "Trung học", "3": "Trung cấp", "4": "Cử nhân", "5": "Thạc sĩ", "6": "Tiến sĩ", "11": "Khác", "12": "Cao đẳng", "-1": "Không xác định"}
API_LEVEL = {"1": "Mới Tốt Nghiệp", "3": "Giám Đốc và Cấp Cao Hơn", "5": "Nhân viên", "7": "Trưởng phòng", "8": "Thực tập sinh/Sinh viên"}
API_COMPANY_SIZE = {"1": "Ít hơn 10", "2": "10-24", "3": "25-99", "4": "100-499", "5": "500-999", "6": "1.000-4.999", "7": "5.000-9.999", "8": "10.000-19.999", "9": "20.000-49.999", "10": "Hơn 50.000"}
WORK_MODE_NAMES = {"at office": "Onsite", "hybrid": "Hybrid", "remote": "Remote"}

#: Titles outside IT, tried after all others.
OTHER_TITLES = [
    ("CEO", ["tổng giám đốc", "general director", "chief executive officer", "ceo"]), ("CFO", ["giám đốc tài chính", "chief financial officer", "cfo"]), ("COO", ["giám đốc vận hành", "chief operating officer", "coo"]),
    ("CMO", ["giám đốc marketing", "chief marketing officer", "cmo"]), ("CHRO", ["giám đốc nhân sự", "chief people officer", "chro"]), ("Chief Accountant", ["kế toán trưởng", "chief accountant"]),
    ("General Accountant", ["kế toán tổng hợp", "general accountant"]), ("Internal Auditor", ["kiểm toán nội bộ", "internal auditor"]), ("Auditor", ["kiểm toán", "auditor"]),
    ("Tax Specialist", ["chuyên viên thuế", "tax specialist", "tax executive", "tư vấn thuế", "tax consultant"]), ("Financial Analyst", ["phân tích tài chính", "financial analyst"]),
    ("Risk Analyst", ["quản lý rủi ro", "risk management", "risk analyst"]), ("Insurance Executive", ["bảo hiểm", "insurance"]), ("Securities Broker", ["môi giới chứng khoán", "securities broker"]),
    ("Securities Analyst", ["chứng khoán", "securities analyst"]), ("Banking Officer", ["ngân hàng", "banking officer", "bank officer"]), ("Finance Executive", ["tài chính", "finance executive", "finance officer"]),
    ("Accountant", ["kế toán", "accountant"]), ("Tax Executive", ["thuế", "tax"]), ("HR Manager", ["trưởng phòng nhân sự", "hr manager", "hr director"]), ("HRBP", ["hrbp", "hr business partner"]),
    ("Talent Acquisition Specialist", ["talent acquisition", "tuyển dụng cấp cao"]), ("Recruiter", ["tuyển dụng", "recruiter", "recruitment"]), ("L&D Executive", ["l&d", "learning and development", "learning & development"]),
    ("C&B Executive", ["c&b", "compensation and benefit", "compensation & benefit"]), ("HR Executive", ["nhân sự", "human resource", "hr executive", "hr staff"]), ("Secretary", ["thư ký", "secretary"]),
    ("Executive Assistant", ["trợ lý giám đốc", "executive assistant"]), ("Assistant", ["trợ lý", "assistant"]), ("Receptionist", ["lễ tân", "receptionist", "front desk"]),
    ("Admin Executive", ["hành chính", "administrative", "admin executive", "admin officer"]), ("Marketing Manager", ["trưởng phòng marketing", "marketing manager"]), ("Digital Marketing Manager", ["digital marketing manager"]),
    ("Performance Marketing Specialist", ["performance marketing", "paid ads", "google ads", "facebook ads", "sem"]), ("Digital Marketing Specialist", ["digital marketing"]), ("SEO Specialist", ["seo specialist", "seo executive"]),
    ("Content Marketing Manager", ["content marketing manager"]), ("Content Writer", ["content writer", "copywriter", "content creator", "content marketing"]),
    ("UA Marketing", ["ua marketing", "user acquisition", "thu hút người dùng"]), ("PR Executive", ["truyền thông", "communications", "public relations", "pr executive", "pr manager"]),
    ("Brand Manager", ["brand manager", "quản lý thương hiệu"]), ("Brand Executive", ["brand", "thương hiệu"]), ("Social Media Manager", ["social media manager"]), ("Social Media Executive", ["social media"]),
    ("Event Manager", ["tổ chức sự kiện", "event manager", "event planner"]), ("Event Executive", ["event coordinator", "event executive"]), ("Marketing Executive", ["marketing"]), ("SEO Specialist", ["seo"]),
    ("Sales Director", ["giám đốc kinh doanh", "sales director", "commercial director"]), ("Sales Manager", ["trưởng phòng kinh doanh", "sales manager"]),
    ("Business Development Manager", ["phát triển kinh doanh", "business development manager"]), ("Business Development Executive", ["phát triển kinh doanh", "business development"]), ("Account Manager", ["account manager"]),
    ("Account Executive", ["account executive"]), ("Telesales Executive", ["telesale", "telesales"]), ("Sales Executive", ["kinh doanh", "bán hàng", "sales executive"]), ("Customer Success Manager", ["customer success manager"]),
    ("Customer Service Executive", ["chăm sóc khách hàng", "customer service", "customer support", "customer success", "dịch vụ khách hàng"]), ("After-Sales Executive", ["after sales", "chăm sóc sau bán"]),
    ("Supply Chain Manager", ["quản lý chuỗi cung ứng", "supply chain manager"]), ("Import/Export Specialist", ["xuất nhập khẩu", "import export", "customs declaration"]), ("Warehouse Manager", ["quản lý kho", "warehouse manager"]),
    ("Warehouse Staff", ["kho vận", "thủ kho", "warehouse staff"]), ("Procurement Manager", ["mua hàng", "purchasing manager", "procurement manager"]), ("Procurement Executive", ["mua hàng", "purchasing", "procurement"]),
    ("Freight Forwarder", ["giao nhận", "freight forwarder"]), ("Transport Executive", ["vận tải", "transport", "freight"]), ("Logistics Executive", ["logistics", "chuỗi cung ứng", "supply chain"]),
    ("Legal Counsel", ["pháp chế", "legal counsel", "in-house lawyer", "luật sư"]), ("Compliance Manager", ["compliance manager", "quản lý tuân thủ"]), ("Compliance Executive", ["compliance", "tuân thủ"]),
    ("Contract Specialist", ["hợp đồng", "contract specialist"]), ("Legal Executive", ["pháp lý", "legal executive", "legal officer"]), ("Lecturer", ["giảng viên", "lecturer", "giáo viên đại học"]),
    ("Teacher", ["giáo viên", "teacher"]), ("Tutor", ["gia sư", "tutor"]), ("Trainer", ["chuyên viên đào tạo", "trainer"]), ("Doctor", ["bác sĩ", "physician", "doctor"]), ("Pharmacist", ["dược sĩ", "pharmacist"]),
    ("Nurse", ["điều dưỡng", "y tá", "nurse"]), ("Lab Technician", ["kỹ thuật viên xét nghiệm", "lab technician"]), ("Healthcare Executive", ["y tế", "healthcare", "medical officer"]), ("Pharma Executive", ["dược", "pharma"]),
    ("Architect", ["kiến trúc sư", "architect"]), ("Interior Designer", ["thiết kế nội thất", "interior designer"]), ("Real Estate Agent", ["môi giới bất động sản", "real estate agent"]),
    ("Real Estate Executive", ["bất động sản", "real estate"]), ("Site Engineer", ["giám sát công trình", "site supervisor", "site engineer"]), ("Construction Executive", ["xây dựng", "construction executive"]),
    ("MEP Engineer", ["mep engineer", "cơ điện lạnh"]), ("Mechanical Engineer", ["kỹ sư cơ khí", "mechanical engineer"]), ("Electronics Engineer", ["kỹ sư điện tử", "electronics engineer"]),
    ("Electrical Engineer", ["kỹ sư điện", "electrical engineer"]), ("Chemical Engineer", ["kỹ sư hóa", "chemical engineer"]), ("Environmental Engineer", ["kỹ sư môi trường", "environmental engineer"]),
    ("Civil Engineer", ["kỹ sư xây dựng", "civil engineer"]), ("Energy Engineer", ["kỹ sư năng lượng", "energy engineer"]), ("Technician", ["kỹ thuật viên", "technician"]), ("Engineer", ["kỹ sư", "engineer"]),
    ("Production Manager", ["quản lý sản xuất", "production manager"]), ("Quality Manager", ["quản lý chất lượng", "quality manager"]), ("Quality Executive", ["chất lượng", "quality assurance", "quality control"]),
    ("HSE Manager", ["an toàn lao động", "hse manager", "safety manager"]), ("HSE Executive", ["an toàn", "safety", "hse"]), ("Maintenance Engineer", ["bảo trì", "maintenance engineer"]),
    ("Maintenance Executive", ["bảo trì", "maintenance"]), ("Production Operator", ["vận hành", "operator", "production operator"]), ("Manufacturing Executive", ["sản xuất", "manufacturing"]),
    ("Graphic Designer", ["graphic designer", "graphic design", "thiết kế đồ họa", "đồ họa", "logo", "poster", "banner", "brochure", "motion graphic", "nội thất", "interior designer", "thời trang", "fashion designer"]),
    ("Art Director", ["art director"]), ("Designer", ["thiết kế", "designer"]), ("Head Chef", ["bếp trưởng", "head chef", "executive chef"]), ("Chef", ["đầu bếp", "chef"]), ("Restaurant Manager", ["nhà hàng", "restaurant manager"]),
    ("F&B Manager", ["f&b manager"]), ("F&B Executive", ["f&b", "food and beverage"]), ("Hotel Manager", ["khách sạn", "hotel manager"]), ("Hospitality Executive", ["hospitality", "khách sạn", "hotel"]),
    ("Travel Executive", ["du lịch", "travel", "tour guide", "hướng dẫn viên"]), ("Spa Manager", ["spa manager"]), ("Beauty Executive", ["spa", "thẩm mỹ", "làm đẹp", "beauty"]), ("Store Manager", ["quản lý cửa hàng", "store manager"]),
    ("Retail Staff", ["nhân viên bán lẻ", "retail staff", "shop staff"]), ("Cashier", ["thu ngân", "cashier"]), ("Director", ["giám đốc", "director"]), ("Manager", ["quản lý", "manager"]),
    ("Team Leader", ["trưởng nhóm", "team leader", "group leader"]), ("Senior Executive", ["chuyên viên cấp cao", "senior specialist", "senior executive"]), ("Specialist", ["chuyên viên", "specialist", "executive officer"]),
    ("Staff", ["nhân viên", "staff", "officer"]), ("Debt Collection Executive", ["thu hồi nợ", "cv/cvc", "debt collection"]), ("Production Supervisor", ["quản đốc xưởng", "quản đốc"]),
    ("Personal Banking Executive", ["quan hệ khách hàng cá nhân", "personal banking"]), ("Banking Officer", ["giao dịch viên"]), ("PR Executive", ["corporate communication"]),
    ("HR Executive", ["organization development", "od executive"]), ("Risk Analyst", ["digital risk", "risk investigator"]), ("Market Research Executive", ["market research", "nghiên cứu thị trường"])]

# Parameters --------------------------------------------------------------------


#: Level words looked for in a title, in order.
TITLE_LEVELS = ("fresher", "junior", "mid", "senior", "lead", "manager", "director", "principal", "intern", "staff", "associate")
#: Parts of a URL that put a posting into the trade.
URL_CATEGORIES = ("/it-phan-mem/", "/it-phan-cung-mang/")


@dataclass
class Vocabulary:
    """Keywords and titles a user adds to the fixed lists: label -> keywords; added titles are tried last, in order."""

    skill_words: dict[str, list[str]] = field(default_factory=dict)
    other_titles: list[tuple[str, list[str]]] = field(default_factory=list)

    def hard_skills(self) -> list[tuple[str, list[str]]]:
        """Each skill by its own name (of more than a letter; and the parts of a name with a slash), its keywords, and what the user adds."""
        return [(s, list(dict.fromkeys([*(n for n in (s.lower(),) if len(n) > 1), *(p for p in s.lower().split("/") if len(p) > 2), *w, *self.skill_words.get(s, [])]))) for s, w in SKILL_WORDS.items()]

    def titles(self) -> list[tuple[str, list[str]]]:
        return [*OTHER_TITLES, *self.other_titles]
