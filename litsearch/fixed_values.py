"""Values that have to be exactly these for results to be right.

Everything below is a fixed value: file formats, patterns of the paper pages,
phrases of the topic rule, messages, limits and ranking constants.
"""

# --- formats -----------------------------------------------------------------
DOCUMENT_COLUMNS = [
    "link", "title", "author", "content", "publisher", "year", "pages",
    "ieee_keys", "author_keys",
]
LIST_SEPARATOR = ";"
NOT_FOUND = "Not found"
NO_KEYS = "None"
MISSING_TERM = "Term does not exist in index"
WRONG_PAIR = "Wrong query format"

# --- patterns of a paper page: column -> (pattern, group) ----------------------
PAPER_RULES = {
    "link": (r'<meta name="parsely-link" content="([^"]*)', 1),
    "title": (r'<h1.+?(?:document-title).+?><span[^>]*>(.+?)<', 1),
    "author": (r'<meta\s+name="parsely-author"\s+content="([^"]*)"', 1),
    "content": (r'<meta property="og:description".*?content="([^"]*)"', 1),
    "publisher": (r'Publisher:\s*<\/span><!----><span .*?>(.*?)<', 1),
    "year": (r'(?:Date of Publication:|Copyright Year:)\s*.*?>\s*([^<]*)', 1),
    "pages": (r'Page\(s\): <\/strong>\s*([0-9]*)', 1),
}
# column -> (pattern of the list block, pattern of one item)
PAPER_LISTS = {
    "ieee_keys": (
        r'>IEEE\sKeywords.*?<ul[^>]*>(.*?)<\/ul>',
        r'<li[^>]*><a[^>]*>(.*?)<\/a>',
    ),
    "author_keys": (
        r'>Author[\(s\)]*\sKeywords.*?<ul[^>]*>(.*?)<\/ul>',
        r'<li[^>]*><a[^>]*>(.*?)<\/a>',
    ),
}
# links to papers on a result page, and the site they belong to
PAPER_LINK_PATTERN = r'(?:href=\")(\/document\/\d+)'
PAPER_LINK_BASE = "https://ieeexplore.ieee.org"
SHORTENED_ENDING = "..."
# what counts as white space at the ends of a page
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- wiki pages ---------------------------------------------------------------
CATEGORY_START = "[[Category:"
CATEGORY_PATTERN = r'\[\[Category:([^]]*)'
KEY_IS_TOPIC_PHRASES = [
    "is a field of study",
    "technology",
    "is a method",
    "is the process of",
    "is a study",
]
NEXT_WORD_IS_TOPIC_PHRASES = [
    "is a field of study in",
    "is a branch of",
    "is an area of knowledge",
    "is the study of",
    "is a method of",
]

# --- search -------------------------------------------------------------------
KEY_COLUMNS = ["ieee_keys", "author_keys", "merged_keys"]
DEFAULT_FIELD = "combined_topics"
BM25_K1 = 1.2
BM25_B = 0.75

# Words are runs of letters, digits and the marks that belong to letters; this splits
# between them, and so at apostrophes and underscores.
WORD_SPLIT = r"[^\p{L}\p{N}\p{M}]+"
