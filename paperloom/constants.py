"""Fixed values.

Every value here must equal the one used by the public formats or by the
workflow this library serves, otherwise results differ.  They are data, not
logic.
"""

# Category name -> integer code; anything else gets UNMATCHED_CATEGORY_CODE.
CATEGORY_CODES = {
    "astro-ph": 0,
    "astro-ph.CO": 1,
    "astro-ph.SR": 2,
    "astro-ph.HE": 3,
    "astro-ph.GA": 4,
    "astro-ph.EP": 5,
    "astro-ph.IM": 6,
}
UNMATCHED_CATEGORY_CODE = 0

# Meta tokens of the normalised text.
MATH_WORD = "latex_metatoken"
MATH_TOKEN = "<latex>"
NUMBER_TOKEN = "<num>"

# Character classes, in the spelling shared by Java and RE2.
WORD_CHARS = r"[\p{L}\p{N}_]"
DIGITS_ONLY = r"^\p{Nd}+$"
FIRST_OTHER_DIGIT = "\u0660"  # the first decimal digit that is not ASCII
ALPHABETIC_CHARS = r"[\p{L}\p{Nl}\p{No}_]"
WHITESPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WHITESPACE_TRIMMED = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Markup: text elements, elements removed with their content, replacements.
TEXT_ELEMENTS = ("section",)
FALLBACK_ELEMENTS = ("para",)
DROPPED_ELEMENTS = (
    "title",
    "note",
    "tabular",
    "caption",
    "toccaption",
    "figure",
    "tags",
    "tag",
    "ERROR",
)
MATH_ELEMENT = "Math"
CITE_ELEMENT = "cite"
PARENTHETICAL_CLASS = "ltx_citemacro_citep"
TEXTUAL_CLASSES = ("ltx_citemacro_citet", "ltx_citemacro_cite")
REFERENCE_NUMBER = r"^[(]?\d*[)]?$"

# Archive manifest.
MANIFEST_ROOT = "manifest"
MANIFEST_ROW = "file"
MANIFEST_FIELDS = (
    "content_md5sum",
    "filename",
    "first_item",
    "last_item",
    "md5sum",
    "num_items",
    "seq_num",
    "size",
    "timestamp",
    "yymm",
)
OVERSIZE_BYTES = 512000000

# Record harvest pages.
HARVEST_ROW = "record"
# Element that holds a record's own fields; each service has its own.
HARVEST_FORMAT = "paper"
HARVEST_ROOT = "OAI-PMH"
HARVEST_TOKEN = "resumptionToken"
HARVEST_SET = "set"

# API feed.
FEED_ROW = "entry"
# Prefix of the service's own elements.
FEED_PREFIX = "ext"

# E-print service.
EPRINT_URL = "https://example.org/e-print/"

# Submission log header.
LOG_HEADER = r"^TARFILE: (.*)\."

# Main file of a submission: preferred names, then the preamble commands.
MAIN_FILE_NAMES = ("ms.tex", "main.tex")
PREAMBLE = r"\\document(class|style)"
STRICT_PREAMBLE = r"(?m)^\\document(?:class|style).*"

# Plural endings of English nouns and what replaces them (published WordNet
# rules of detachment).
NOUN_ENDINGS = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)

# Folder listing of the mirror.
FOLDER_MIME = "application/vnd.google-apps.folder"
