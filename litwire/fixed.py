"""Fixed values.

Results depend on these word lists, patterns, labels and limits being exactly
as written; they are stated here as plain values, in natural order.
"""

# Articles removed from titles before comparison.
TITLE_ARTICLES = ["the", "a", "an"]

# Scores in hundredths.
TITLE_HIT = 45
BODY_HIT = 8
NEGATIVE_PENALTY = 40
PAPER_MIN_SCORE = 18
NEWS_MIN_SCORE = 24
MIN_TERM_CHARS = 4
NEGATIVE_MENTION = r"\b(negative|tested negative|no evidence of)\b.{0,80}"

# Title similarity thresholds (percent).
PAPER_TITLE_RATIO = 94
NEWS_TITLE_RATIO = 84
LINK_RATIO = 78
REVIEW_LOW, REVIEW_HIGH = 72, 94
CONFLICT_RATIO = 58
AUTHOR_RATIO = 70
REVIEW_GROUPS, REVIEW_GROUP_SIZE = 8, 6

# Availability date: candidates in order of preference.
DATE_ORDER = [
    "online_date",
    "first_publication_date",
    "created_date",
    "indexed_date",
    "published_date",
    "print_date",
]

# Merge: fields where the first non-empty value wins.
FILL_FIELDS = [
    "doi",
    "journal",
    "year",
    "volume",
    "issue",
    "pages",
    "online_date",
    "created_date",
    "indexed_date",
    "published_date",
    "print_date",
    "availability_date",
    "availability_date_basis",
    "url",
]

# Issue limits.
WINDOW_DAYS = 7
MAX_PAPERS, MAX_NEWS, MAX_FULLTEXTS, MAX_NEWS_FETCHES = 24, 36, 18, 50
MAX_QUERY_GROUPS = 7
MAX_TERMS, MAX_TOPICS, MAX_NEGATIVES = 12, 10, 8
HISTORY_ROWS = 365
MEMORY_ROWS = 5000
FEED_ITEMS = 10
ID_CAP, ID_BATCH = 250, 100

# Content.
PAPER_STOP_CHARS, NEWS_STOP_CHARS, PAPER_MIN_CHARS = 6000, 800, 400
PAPER_MAX_CHARS, NEWS_MAX_CHARS, SECTION_MAX_CHARS = 18000, 14000, 8000
CONTENT_FULL, CONTENT_PARTIAL = 1800, 300
MAX_CANDIDATES = 12
CONTEXT_MIN_CHARS, CONTEXT_MAX_CHARS = 200, 18000
IDENTITY_TITLE_CHARS, IDENTITY_DOI_CHARS, IDENTITY_AUTHOR_CHARS = 2500, 12000, 8000

# Evidence sentences kept per kind.
EVIDENCE_ABSTRACT, EVIDENCE_FULL, EVIDENCE_NEWS = 24, 36, 45
MIN_SENTENCE_CHARS = 20

DOI = r"10\.\d{4,9}/[-._;()/:A-Z0-9]+"
EVENT_WORDS = r"\b(outbreak|case|death|quarantine|alert|confirmed|suspected|response)\b"
REVIEW_WORDS = (
    r"\b(review|systematic review|meta-analysis|narrative review|scoping review"
    r"|viewpoint|perspective|commentary)\b"
)
BOILERPLATE = [
    r"comprehensive up[- ]to[- ]date news coverage",
    r"aggregated from sources all over the world",
    r"google news provides",
    r"by google news",
    r"view full coverage",
    r"click here to read more",
    r"original abstract or excerpt is unavailable",
]

# Section buckets by words in the heading, tried in this order.
SECTION_WORDS = [
    ("methods", ["method", "material", "patient", "study design"]),
    ("results", ["result", "finding"]),
    ("discussion", ["discussion"]),
    ("conclusion", ["conclusion", "summary"]),
]

# Analysis elements and their labels.
RESEARCH_FIELDS = ["background", "methods", "results", "contribution", "limitations"]
REVIEW_FIELDS = ["background", "main_directions", "current_state", "gaps", "future_research"]
NEWS_FIELDS = ["time", "location", "event", "impact", "status"]
RESEARCH_LABELS = ["背景", "方法", "结果", "贡献", "局限"]
REVIEW_LABELS = ["背景", "主要方向", "研究现状", "不足", "后续研究"]
NEWS_LABELS = ["时间", "地点", "事件", "影响", "状态"]

# Statements used where evidence is missing.
NOT_IN_EVIDENCE = "未从现有证据中明确报告。"
READ_FULL_TEXT = "需阅读全文进一步判断。"
READ_FULL_TEXT_FUTURE = "需根据全文进一步判断。"
EVIDENCE_LIMIT = "当前仅依据已获得的摘要或正文片段，未进行超出证据的推断。"
NEWS_NOT_REPORTED = "未报告"
NEWS_NOT_IN_EVIDENCE = "未从现有证据中明确报告"
NEWS_VERIFY = "需进一步核实"
NEWS_NO_LOCATION = "未从标题或来源元数据中可靠确定"
NEWS_NO_EVENT = "未抓获新闻正文，不能根据标题扩写事件内容"
NEWS_NO_IMPACT = "未获得正文，无法判断"
NEWS_NO_STATUS = "仅保留标题和来源元数据"
TITLE_UNAVAILABLE = "中文标题翻译暂不可用"

# Translation: wrong rendering -> right rendering, applied in this order.
REPAIRS = [
    ("汉塔病毒", "汉坦病毒"),
    ("韩坦病毒", "汉坦病毒"),
    ("宋病毒", "汉坦病毒"),
    ("安第斯汉坦病毒", "安第斯病毒"),
    ("安第斯 hantavirus", "安第斯病毒"),
    ("汉坦病毒肆虐的", "发生汉坦病毒疫情的"),
    ("汉坦病毒肆虐", "发生汉坦病毒疫情"),
    ("明显的汉坦病毒疫情", "疑似汉坦病毒疫情"),
    ("明显汉坦病毒疫情", "疑似汉坦病毒疫情"),
]
FORBIDDEN = ["宋病毒", "汉塔病毒", "韩坦病毒"]

# Topics of the default query groups.
DEFAULT_GROUPS = [
    ("core", 8, []),
    ("clinical", 5, ["infection", "disease", "diagnosis", "treatment"]),
    ("epidemiology", 5, ["outbreak", "surveillance", "epidemiology", "case"]),
    ("ecology", 5, ["reservoir", "host", "ecology", "spillover"]),
]

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Elements whose text is no part of a page's main text, and tags that end a block of text.
UNSEEN_TAGS = ["head", "script", "style", "template", "noscript", "nav", "header", "footer", "form", "aside", "button"]
BLOCK_TAGS = [
    "html", "body", "main", "article", "section", "div", "p", "pre", "blockquote", "h[1-6]", "hr", "ul", "ol", "li",
    "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "figure", "figcaption", "address",
]
