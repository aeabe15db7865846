"""Invented inputs with the features the operators have to deal with."""

PAPER_PAGES = [
    # everything there
    ('<head><meta name="parsely-link" content="https://x.org/document/1">'
     '<meta name="parsely-author" content="Ada Byron"><meta property="og:description" '
     'content="A first abstract."></head><h1 class="document-title text"><span class="t">First title</span></h1>'
     '<div><strong>Page(s): </strong> 12 - 20</div>'
     '<span>Publisher: </span><!----><span class="p">IEEE</span>'
     '<div>Date of Publication: <span>03 May 2019</span></div>'
     '<strong>IEEE Keywords</strong><ul class="k"><li class="i"><a href="#">Deep learning</a></li>'
     '<li><a href="#">Voltage</a></li></ul>'
     '<strong>Author Keywords</strong><ul><li><a>graphs</a></li></ul>'),
    # no abstract, the other headings, a tab and newlines inside
    ('<meta name="parsely-link" content="https://x.org/document/2">\n'
     '<h1 class="document-title"\t><span>Second\n title</span></h1>'
     '<div>Copyright Year: <span>2020</span></div>'
     '<strong>Author(s) Keywords</strong><ul><li><a>c++</a></li>\n<li><a>python</a></li></ul>'),
    # abstract cut short
    '<meta property="og:description" content="It goes on...">',
    # abstract of one dot
    '<meta property="og:description" content=".">',
    # nothing at all
    '<html><body>no such page</body></html>',
]

# blanks and line ends of other kinds where the patterns have room for some
UNUSUAL_PAGES = [
    ('<h1 class="document-title"><span>A\u2028title</span></h1>'
     '<strong>Page(s): </strong>\xa0\u200912 - 20<span>Publisher:\xa0</span><!----><span class="p">ACM</span>'
     '<meta property="og:description" \u2028 content="One\x85line\u2029and more">'
     '<strong>IEEE\xa0Keywords</strong><ul class="k"><li class="i"><a href="#">a\u2028b</a></li></ul>'),
    ('<div>Copyright Year:\u3000<b>\xa0</b>\xa0 2020</div><strong>Author\u2003Keywords</strong>\u2029'
     '<ul><li><a>x</a></li></ul>'),
]

WIKI_DUMP = """<mediawiki>
<page><title>Voltage</title><id>1</id><revision><id>9</id><text bytes="4">Voltage is a method of [[Category:Physics]]</text></revision></page>
<page><title>Other</title><id>2</id><redirect title="Graphs" /><revision><text>Graphs here. [[Category:Maths|graphs]] [[Category:Sets]]</text></revision></page>
<page><title>Graphs</title><id>3</id><redirect title="Voltage" /><revision><text>no category</text></revision></page>
<page><title>voltage</title><id>4</id><revision><text>[[Category:Later page]]</text></revision></page>
<page><title>C++</title><id>5</id><revision><text>C++ is a branch of computing [[Category:Languages|c]] [[Category:Computing]] [[Category:Code]]</text></revision></page>
<page><title>Python</title><id>6</id><revision><text /></revision></page>
<page><title>Unasked</title><id>7</id><redirect title="Nobody" /><revision><text>[[Category:X]]</text></revision></page>
</mediawiki>
"""

# key, text, topics
TOPIC_TEXTS = [
    ("voltage", "Here VOLTAGE is a method to measure. [[Category:A]] [[Category:B]]", ["voltage"]),
    ("nets", "This is the study of nets. [[Category:A]] [[Category:B]] [[Category:C]]", ["B", "A", "C"]),
    ("nets", "This is the study of nets. [[Category:A]]", ["A"]),
    ("nets", "Nets catch fish. [[Category:A|a]] [[Category:B]]", ["A", "B"]),
    ("c++", "In C++ technology (sic). [[Category:A]]", ["c++"]),
    ("nets", "Nets catch fish.", ["Not found"]),
]

# the corpus of the six sample queries: columns as an enriched table has them
CORPUS_COLUMNS = ["doc_id", "link", "title", "author", "content", "publisher", "year", "pages",
                  "ieee_keys", "author_keys", "merged_keys", "combined_topics"]


def _paper(doc_id, title="Some paper", author="Nobody", content="text", publisher="ACM",
           keys=(), topics=()):
    keys, topics = list(keys), list(topics)
    return (doc_id, f"https://x.org/document/{doc_id}", title, author, content, publisher, "2020",
            "1", keys, [], keys, topics)


CORPUS = [
    _paper(1, author="Wei Xu;Ann Lee"),
    _paper(2, author="Wei Li;Xu Wei"),                       # both words, never in that order
    _paper(3, title="Wei Xu remembered"),                    # phrase in another field
    _paper(4, topics=["Voltage", "Energy"]),
    _paper(5, topics=["Voltage regulation"]),
    _paper(6, topics=["Water regulation"]),                  # found by a word, counted by no topic
    _paper(7, content="We use Python here", publisher="IEEE", keys=["Data Science", "tools"]),
    _paper(8, content="We use Python here", publisher="IEEE", keys=["science", "data"]),
    _paper(9, title="An analysis swarm method", topics=["Topology"]),
    _paper(10, title="Swarm analysis", topics=["Topology", "Wire", "Data security"]),
    _paper(11, title="Federated systems", topics=["Machine learning", "Privacy", "Quality control"]),
    _paper(12, title="Federated systems", topics=["Machine tools", "learning", "Privacy law"]),
]

# query → clause rows, best-known answers
SAMPLE_CLAUSES = [
    ("s1", 0, "author", "phrase", "Wei Xu", "must"),
    ("s2", 0, "combined_topics", "any_word", "voltage", "should"),
    ("s2", 1, "combined_topics", "any_word", "voltage regulation", "should"),
    ("s3", 0, "merged_keys", "phrase", "data science", "must"),
    ("s3", 1, "publisher", "term", "IEEE", "must"),
    ("s3", 2, "content", "term", "python", "must"),
    ("s4", 0, "combined_topics", "term", "topology", "must"),
    ("s4", 1, "title", "phrase", "analysis swarm", "must"),
    ("s5", 0, "combined_topics", "any_word", "wire", "should"),
    ("s5", 1, "combined_topics", "any_word", "data security", "should"),
    ("s5", 2, "combined_topics", "any_word", "quality control", "should"),
    ("s6", 0, "combined_topics", "phrase", "Machine learning", "must"),
    ("s6", 1, "combined_topics", "term", "privacy", "must"),
    ("s6", 2, "title", "term", "federated", "must"),
]
SAMPLE_ANSWERS = {
    "s1": {1}, "s2": {4, 5, 6}, "s3": {7}, "s4": {9}, "s5": {10, 11}, "s6": {11},
}
SAMPLE_COUNTS = {
    "s2": [("voltage", 1), ("voltage regulation", 1)],
    "s5": [("data security", 1), ("quality control", 1), ("wire", 1)],
}
