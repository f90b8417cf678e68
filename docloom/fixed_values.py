"""Patterns and defaults that decide what the results are.

Patterns are written in the syntax that ``java.util.regex`` and RE2 share, so
the same text serves a Spark expression and a DuckDB check query.

Flags: ``m`` lets ``^`` and ``$`` match at every line; ``s`` lets ``.`` match
a line feed.  The Spark side adds ``d`` (only a line feed ends a line) where
``.``, ``^`` or ``$`` occur, see :func:`docloom.functions.text.line_mode`.
"""

# White space as Unicode text processing in the source pipeline knows it.  It
# is spelled out because Java's and RE2's own classes are narrower.
SPACE_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
SPACE_CHARS = "".join(map(chr, SPACE_CODES))
SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same class without the line feed, for matches that stay on one line.
SPACE_IN_LINE = (
    r"\t\x0b-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# A word character: any letter or number of any script, or an underscore.
WORD = r"\p{L}\p{N}_"

# --- technical clean -------------------------------------------------------
FIGURE_BLOCK = r"(?s)<figure>.*?</figure>"
IMG_WITH_DATA_URI = rf"<img[{SPACE}][^>]*data:image/[^>]*>"
MD_IMAGE_WITH_DATA_URI = r"!\[.*?\]\(data:image/[^)]+\)"
MD_IMAGE_WITH_DATA_URI_STRICT = r"!\[[^\]]*\]\(data:image/[^)]+\)"
BARE_DATA_URI = rf"data:image/[^;]+;base64,[A-Za-z0-9+/={SPACE}]+"
BARE_DATA_URI_STRICT = r"data:image/[^;]+;base64,[A-Za-z0-9+/=]+"
ATTRIBUTE_REFERENCE = rf"\{{[A-Za-z][{WORD}-]*\}}"

# --- reasoning traces ------------------------------------------------------
REASONING_TAGS = ("think", "reasoning", "reflection")

# --- chunking --------------------------------------------------------------
SECTION_HEADER = r"^#{1,3} "
PARAGRAPH_BREAK = r"\n\n+"
MAX_CHUNK_CHARS = 2500
BATCH_SIZE = 25

# --- AsciiDoc --------------------------------------------------------------
ATTRIBUTE_LINE = rf"^:([A-Za-z][{WORD}-]*?):[{SPACE_IN_LINE}]*(.*?)[{SPACE_IN_LINE}]*$"
ATTRIBUTE_ACROSS_LINES = rf"^:([A-Za-z][{WORD}-]*?):[{SPACE}]*(.*?)[{SPACE}]*$"
INCLUDE_START = "include::"
BLOCK_ID_LINE = rf'^\[id="[^"]*".*\][{SPACE}]*$'
CONDITIONAL_STARTS = ("ifdef::", "ifndef::", "endif::")
DEFINITION_START = rf"^:[{WORD}-]+:"
# Attributes every document starts with; a document's own definition wins.
DEFAULT_ATTRIBUTES = (
    ("product-title", "OpenShift Container Platform"),
    ("product-version", ""),
    ("VirtProductName", "OpenShift Virtualization"),
    ("op-system-base-full", "Red Hat Enterprise Linux (RHEL)"),
    ("op-system-base", "RHEL"),
    ("kebab", "&#8942;"),
)

# --- documents -------------------------------------------------------------
SUPPORTED_EXTENSIONS = (".adoc", ".pdf")
MERGE_SEPARATOR = "\n\n---\n\n"

# --- generation ------------------------------------------------------------
DOMAIN = "General"
OUTLINE = ""
REQUEST_TIMEOUT_S = 600

# --- comparison ------------------------------------------------------------
BASE_MODEL_FIELD = "base_model_name_or_path"
