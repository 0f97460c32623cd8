"""Fixed values shared by the jobs.

They have to equal the values of the workload this engine serves, otherwise
results differ; they are therefore stated here as plain constants.  Every job
takes them as keyword arguments, so another corpus can override them.
"""

# --- deduplication (fixed values) ---
MIN_PARAGRAPH_CHARS = 50
MIN_DOCUMENT_CHARS = 20

# --- tokenizer (fixed values) ---
VOCAB_SIZE = 50257
MIN_FREQUENCY = 2
SPECIAL_TOKEN = "<|endoftext|>"
# GPT-2 pre-token pattern, in Java syntax with Unicode classes switched on.
PRETOKEN_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# --- mixture, split, packing (fixed values) ---
SEED = 42
EVAL_RATIO = 0.01
VERSE_EVAL_RATIO = 0.1
BLOCK_LENGTH = 1024
MAP_BATCH_ROWS = 1000
TOKEN_BUDGET = 2_480_000_000
BATCH_PER_DEVICE = 2
GRADIENT_ACCUMULATION = 64
DEVICES = 2
SOURCE_ROW_CAP = 2_740_000

# --- verse samples (fixed values) ---
VERSE_PREFIX = "thơ:\n"
VERSE_LINES = 4
VERSE_WORDS_PER_LINE = 5
SAMPLE_LENGTH = 64
IGNORED_LABEL = -100

# --- listing pages (fixed values) ---
MAX_LISTING_PAGES = 10
BLOCKED_LISTING_MARKERS = [
    "Danh sách quá dài",
    "Access denied",
    "Too many requests",
    "403 Forbidden",
]
BLOCKED_PAGE_MARKERS = ["Xác nhận không phải máy"]
UNKNOWN_AUTHOR = "Unknown"
LISTING_URL = "https://www.thivien.net/search-poem.php?PoemType=16"
LISTING_COUNTRY = "&Country=2"
# (sort column, direction) of every listing walked in the first phase
LISTING_SORTS = [
    ("", ""),
    ("Author", "asc"),
    ("Author", "desc"),
    ("Views", "desc"),
    ("Views", "asc"),
    ("Date", "asc"),
    ("Date", "desc"),
    ("Poster", "asc"),
    ("Poster", "desc"),
]
ARTICLE_URL = "https://vi.wikipedia.org/wiki/"

# --- wikitext (fixed values) ---
# Tags replaced by a blank; a name matches as a prefix, as in "<b" of "<body>".
BLANKED_TAGS = [
    "div", "span", "small", "big", "b", "i", "u", "s", "br", "p", "table", "tr",
    "th", "td", "ul", "ol", "li", "dl", "dt", "dd", "sub", "sup", "blockquote",
    "nowiki", "code", "pre", "gallery", "imagemap", "timeline", "score",
    "syntaxhighlight", "source", "poem", "section", "indicator",
    "templatestyles", "hiero", "math", "chem",
]
# Link namespaces whose links vanish completely.
DROPPED_NAMESPACES = [
    "file:", "image:", "tập tin:", "hình:", "ảnh:", "category:", "thể loại:",
    "media:",
]
# Section titles that end an article; words may be separated by any white space.
TERMINAL_SECTIONS = [
    "Tham khảo", "Chú thích", "Ghi chú", "Liên kết ngoài", "Xem thêm",
    "Thư mục", "Đọc thêm", "Nguồn tham khảo", "Chú giải",
    "Ghi chú và tham khảo", "References?", "External links?", "See also",
    "Notes?", "Bibliography", "Further reading",
]
