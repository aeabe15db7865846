"""Personal data: fixed rules, and a semi-Markov conditional random field that adds to them.

The rules find e-mail addresses, IPv4 addresses, card numbers and phone numbers in their
usual form; what they find always stays. The random field looks at the digits and ``@``
that no rule has covered. It cuts the text around them into segments: single tokens outside
of any entity, or entities of at most ``MOST_TOKENS`` tokens, and scores a segment by
features of the whole span (its shape, how many digits, separators, checksum, the word
before) for each kind, and the kind by the one before it. Dynamic programming picks
boundaries and kinds together; an entity is added if it beats leaving its tokens outside by
``MARGIN``. So forms like ``(274) 555-9629``, ``name [at] host.org`` or ``2001:db8::7``
are found, dates, versions and keys are not.

Weights are fitted by the gradient of the likelihood on written-out forms of each kind,
on things that look alike, and on at most ``SAMPLE`` places of the corpus, labelled by the
rules (a bounded sample, drawn by a hash of the id).

Defined cases: a null text counts as empty and has no spans. Spans are code points, end
exclusive. Stretches of more than ``REGION`` characters are read in pieces that overlap by twice
``OVERLAP`` characters, so an entity of up to ``OVERLAP`` characters lies whole in the piece it starts in. Repeated
rows give repeated rows. Columns other than id and text are not read.
"""

import random
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litsearch.llm.common import hash_limit, strings, table

#: Kinds in the order they are listed.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a run of digits is tried once, from its first digit: the result is the same
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
DIGIT = re.compile(r"[0-9]")

SAMPLE, SAMPLE_TEXTS = 1500, 20_000
MOST_TOKENS, REGION, AROUND, OVERLAP, MARGIN = 16, 400, 40, 100, 3.0
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^A-Za-z0-9\s]")
TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]")
EDGE = re.compile(r"[A-Za-z0-9+(]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, looking back from each @ instead of forward from each letter."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text, start - 1):
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """What the rules find, by kind."""
    out = {kind: [] for kind in KINDS}
    if "@" in text:
        out["email"] = list(emails(text))
    if DIGIT.search(text):
        out["ip"] = [m.span() for m in IP.finditer(text)
                     if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            if 16 <= m.end() - m.start():
                digits = NOT_DIGIT.sub("", m.group())
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in PHONE.finditer(text)
                            if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def digest(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(spans[kind]))


# --- the random field ----------------------------------------------------------

LABELS = ("outside", *KINDS)


def char_class(c: str) -> str:
    return ("edge" if not c else "letter" if c.isalpha() else "digit" if c.isdigit()
            else "blank" if c.isspace() else c)


def bucket(n: int, bounds=(0, 1, 2, 3, 4, 5, 6, 7, 9, 11, 12, 15, 16, 19, 24)) -> int:
    return next((b for b in bounds if n <= b), 99)


def span_features(text: str, a: int, b: int) -> list[str]:
    """Features of the whole span."""
    s = text[a:b]
    digits = NOT_DIGIT.sub("", s)
    letters = re.findall(r"[A-Za-z]+", s)
    groups = re.findall(r"[0-9]+", s)
    before = re.search(r"([A-Za-z]+)[^A-Za-z0-9]*$", text[max(0, a - 20):a])
    left, right = text[a - 1:a], text[b:b + 1]
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", re.sub(r"\s+", " ", s)))
    out = [f"shape={shape[:12]}", f"digits={bucket(len(digits))}", f"left={char_class(left)}",
           f"right={char_class(right)}", f"first={char_class(s[0])}", f"last={char_class(s[-1])}",
           "separators=" + "".join(sorted(set(re.sub(r"[A-Za-z0-9]", "", s)))),
           f"groups={len(groups)}", f"words={bucket(len(letters))}",
           "lengths=" + ".".join(str(min(len(g), 9)) for g in groups[:6])]
    if before:
        out.append(f"before={before.group(1).lower()}")
    if letters and groups:
        out.append("mixed" if re.search(r"[A-Za-z][0-9]|[0-9][A-Za-z]", s) else "apart")
    if "@" in s or re.search(r"[\[(]at[\])]", s):
        tail = re.search(r"\.([A-Za-z]{2,})$", s)
        out.append(f"at-domain={bool(tail)}")
    if len(digits) >= 13:
        out.append(f"luhn={luhn(digits)},{len(digits) in range(13, 20)}")
    if len(groups) == 4 and set(re.sub("[0-9]", "", s)) <= {"."}:
        out.append(f"octets={all(int(g[:9]) < 256 for g in groups)}")
    if re.fullmatch(r"([0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}", s) and ("::" in s or s.count(":") == 7):
        out.append("colon-groups")
    return out


def token_features(token: str) -> list[str]:
    return [f"token={char_class(token[0])}", f"token-length={char_class(token[0])}{bucket(len(token))}"]


class Lattice:
    """Tokens of a region and the segments an entity may be."""

    def __init__(self, text: str, start: int, end: int, blocked: list[tuple[int, int]] = ()):
        found = [m.span() for m in TOKEN.finditer(text, start, end)]
        self.bounds = [a for a, _ in found] + [found[-1][1] if found else start]
        self.tokens = [text[a:b] for a, b in found]
        shut = np.zeros(end - start + 1, np.int64)
        trigger = np.zeros(end - start + 1, np.int64)
        for a, b in blocked:
            shut[max(0, a - start):max(0, b - start)] = 1
        for m in TRIGGER.finditer(text, start, end):
            trigger[m.start() - start:m.end() - start] = 1
        shut, trigger = (np.concatenate(([0], np.cumsum(x))) for x in (shut, trigger))
        self.segments = []
        first = [bool(EDGE.match(t)) for t in self.tokens]
        last = [t[0].isalnum() for t in self.tokens]
        for i in range(len(found)):
            if not first[i] or text[self.bounds[i] - 1:self.bounds[i]].isalnum():
                continue
            a = self.bounds[i]
            for j in range(i + 1, min(len(found), i + MOST_TOKENS) + 1):
                b = self.bounds[j]
                if shut[b - start] > shut[a - start]:
                    break
                if (last[j - 1] and trigger[b - start] > trigger[a - start]
                        and not text[b:b + 1].isalnum()):
                    self.segments.append((i, j))
        self.features = [span_features(text, self.bounds[i], self.bounds[j]) for i, j in self.segments]


class Weights:
    """A weight for each feature and label, and for a label after another."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.values = np.zeros((0, len(LABELS)))
        self.after = np.zeros((len(LABELS), len(LABELS)))

    def ids(self, names: list[str], grow: bool = False) -> list[int]:
        if grow:
            return [self.index.setdefault(n, len(self.index)) for n in names]
        return [self.index[n] for n in names if n in self.index]

    def scores(self, lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
        """Of every token outside, and of every segment as every label."""
        known = getattr(lattice, "known", None)
        if known:
            (tokens, token_at), (spans, span_at) = known
            inside = np.add.reduceat(self.values[spans], span_at) if len(spans) else np.zeros((0, len(LABELS)))
            return np.add.reduceat(self.values[tokens, 0], token_at), inside
        out = np.array([self.values[self.ids(token_features(t)), 0].sum() for t in lattice.tokens])
        inside = np.array([self.values[self.ids(f)].sum(axis=0) for f in lattice.features])
        return out, inside.reshape(-1, len(LABELS))


def arrivals(lattice: Lattice) -> list[list[int]]:
    """Numbers of the segments that end at each token bound."""
    out: list[list[int]] = [[] for _ in range(len(lattice.tokens) + 1)]
    for n, (_, j) in enumerate(lattice.segments):
        out[j].append(n)
    return out


def best_path(lattice: Lattice, weights: Weights) -> list[tuple[int, int, str]]:
    """Entities (start, end, kind) of the best segmentation that beat their tokens by the margin."""
    n, k = len(lattice.tokens), len(LABELS)
    out, inside = weights.scores(lattice)
    value, came = np.full((n + 1, k), -np.inf), {}
    value[0, 0] = 0
    ends = arrivals(lattice)
    for j in range(1, n + 1):
        step = value[j - 1] + weights.after[:, 0]
        value[j, 0], came[j, 0] = step.max() + out[j - 1], (j - 1, int(step.argmax()), -1)
        for s in ends[j]:
            i = lattice.segments[s][0]
            step = value[i][:, None] + weights.after
            reach, label = step.max(axis=0) + inside[s], step.argmax(axis=0)
            for y in range(1, k):
                if reach[y] > value[j, y]:
                    value[j, y], came[j, y] = reach[y], (i, int(label[y]), s)
    found, j, y = [], n, int(value[n].argmax())
    while j:
        i, before, s = came[j, y]
        if y and inside[s, y] - out[i:j].sum() > MARGIN:
            found.append((lattice.bounds[i], lattice.bounds[j], LABELS[y]))
        j, y = i, before
    return found[::-1]


def gradient(lattice: Lattice, truth: list[tuple[int, int, int]], weights: Weights):
    """Observed less expected use of features and label pairs (forward and backward sums)."""
    n, k = len(lattice.tokens), len(LABELS)
    out, inside = weights.scores(lattice)
    after, ends = weights.after, arrivals(lattice)
    ahead = np.full((n + 1, k), -np.inf)
    ahead[0, 0] = 0
    add = np.logaddexp.reduce
    for j in range(1, n + 1):
        ahead[j, 0] = add(ahead[j - 1] + after[:, 0]) + out[j - 1]
        for s in ends[j]:
            reach = add(ahead[lattice.segments[s][0]][:, None] + after, axis=0) + inside[s]
            ahead[j, 1:] = np.logaddexp(ahead[j, 1:], reach[1:])
    begin = [[] for _ in range(n + 1)]
    for s, (i, _) in enumerate(lattice.segments):
        begin[i].append(s)
    behind = np.full((n + 1, k), -np.inf)
    behind[n] = 0
    pairs = np.zeros((k, k))
    tokens, spans = np.zeros(n), np.zeros((len(lattice.segments), k))
    total = add(ahead[n])
    for i in range(n - 1, -1, -1):
        outside = after[:, 0] + out[i] + behind[i + 1, 0]
        behind[i] = outside
        share = np.exp(ahead[i] + outside - total)
        tokens[i] = share.sum()
        pairs[:, 0] += share
        for s in begin[i]:
            step = after[:, 1:] + inside[s, 1:] + behind[lattice.segments[s][1], 1:]
            behind[i] = np.logaddexp(behind[i], add(step, axis=1))
            share = np.exp(ahead[i][:, None] + step - total)
            spans[s, 1:] = share.sum(axis=0)
            pairs[:, 1:] += share
    # the true segmentation: entities, all else outside
    covered, tokens, spans, pairs = np.zeros(n, bool), -tokens, -spans, -pairs
    number = {seg: s for s, seg in enumerate(lattice.segments)}
    label_at = {}
    for i, j, y in truth:
        spans[number[i, j], y] += 1
        covered[i:j] = True
        label_at[i] = (j, y)
    at, before = 0, 0
    while at < n:
        at_next, y = label_at.get(at, (at + 1, 0))
        pairs[before, y] += 1
        tokens[at] += not covered[at]
        at, before = at_next, y
    return tokens, spans, pairs


def fit(examples: list[tuple[str, list[tuple[int, int, str]]]], rounds: int = 5, rate: float = 0.5,
        decay: float = 1e-3) -> Weights:
    """Maximum likelihood with a scaled step for each weight."""
    weights = Weights()
    data = []
    for text, entities in examples:
        lattice = Lattice(text, 0, len(text))
        place = {b: i for i, b in enumerate(lattice.bounds)}
        truth = [(place.get(a), place.get(b), LABELS.index(kind)) for a, b, kind in entities]
        if lattice.tokens and all(t[:2] in set(lattice.segments) for t in truth):
            span_ids = [weights.ids(f, True) for f in lattice.features]
            token_ids = [weights.ids(token_features(t), True) for t in lattice.tokens]
            # names are looked up once; every segment and token has some
            lattice.known = [(np.array(sum(x, []), np.int64), np.cumsum([0, *map(len, x[:-1])]) if x else None)
                             for x in (token_ids, span_ids)]
            here = np.unique(np.concatenate([ids for ids, _ in lattice.known]))
            data.append((lattice, truth, here, [np.searchsorted(here, x) for x in span_ids],
                         [np.searchsorted(here, x) for x in token_ids]))
    weights.values = np.zeros((len(weights.index), len(LABELS)))
    seen, seen_pairs = np.full_like(weights.values, 1e-6), np.full_like(weights.after, 1e-6)
    rng = random.Random(5)
    for _ in range(rounds):
        rng.shuffle(data)
        for lattice, truth, here, span_ids, token_ids in data:
            tokens, spans, pairs = gradient(lattice, truth, weights)
            step = np.zeros((len(here), len(LABELS)))  # of the features at hand only
            for ids, g in zip(token_ids, tokens):
                step[ids, 0] += g
            for ids, g in zip(span_ids, spans):
                step[ids] += g
            moved = step.any(axis=1)
            used = here[moved]
            step = step[moved] - decay * weights.values[used]
            seen[used] += step**2
            weights.values[used] += rate * step / np.sqrt(seen[used])
            seen_pairs += pairs**2
            weights.after += rate * pairs / np.sqrt(seen_pairs)
    return weights


def written_examples(n: int = 60, seed: int = 6) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Forms of each kind in which the rules do not know them, and things that look alike."""
    rng = random.Random(seed)

    def d(k: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(k))

    def word() -> str:
        return "".join(rng.choice("abcdefghiklmnoprstuvwxyz") for _ in range(rng.randint(2, 8)))

    def card() -> str:
        head = d(15)
        return next(head + c for c in "0123456789" if luhn(head + c))

    def v6() -> str:
        groups = [f"{rng.randrange(1, 65536):x}" for _ in range(8)]
        return rng.choice((":".join(groups), ":".join(groups[:3]) + "::" + groups[4], "2001:db8::" + groups[1]))

    def fours(s: str, by: str) -> str:
        return by.join(s[i:i + 4] for i in range(0, 16, 4))

    forms = {
        "email": [lambda: f"{word()} [at] {word()}.{rng.choice(('com', 'org', 'net', 'de'))}",
                  lambda: f"{word()}(at){word()}.{word()}.com",
                  lambda: f"{word()}{d(2)} (at) {word()}.org", lambda: f"{word()}@{word()}.{word()}.com"],
        "ip": [v6],
        "card": [lambda: fours(card(), "."), lambda: fours(card(), "  "), lambda: fours(card(), "_")],
        "phone": [lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}",
                  lambda: f"00{d(2)} {d(3)} {d(3)} {d(4)}", lambda: f"({d(3)}) {d(3)} {d(4)}"],
    }
    alike = [lambda: f"{d(1)}.{d(1)}", lambda: f"{d(1)}.{d(1)}.", lambda: f"{d(1)}.{d(2)}.{d(1)}",
             lambda: f"20{d(2)}-0{d(1)}-1{d(1)}", lambda: f"1{d(1)}/0{d(1)}/20{d(2)}",
             lambda: f"1{d(1)}:{d(2)}:{d(2)}", lambda: f"${d(1)},{d(3)}.{d(2)}", lambda: f"20{d(2)}",
             lambda: f"19{d(2)}-19{d(2)}", lambda: d(rng.randint(1, 12)), lambda: d(rng.choice((13, 14, 16, 20))),
             lambda: f"{d(2)}-{d(2)}", lambda: f"{d(1)}.{d(5)}", lambda: f"{d(2)}%", lambda: f"({d(1)})",
             lambda: f"{rng.getrandbits(96):x}", lambda: f"password={rng.getrandbits(72):x}",
             lambda: f'token = "{rng.getrandbits(160):x}"', lambda: f"@{word()}", lambda: f"{word()}{d(2)}",
             lambda: "AKIA" + "".join(rng.choice("ABCDEFGHJKLM234567") for _ in range(16)),
             lambda: f"{d(3)}.{d(3)}.{d(3)}.{d(3)}", lambda: f"{d(3)}-{d(4)}", lambda: f"{word()} @ {d(2)}",
             lambda: f"978-{d(1)}-{d(3)}-{d(5)}-{d(1)}", lambda: f"{d(3)} {d(3)}", lambda: f"{d(1)} {d(2)} {d(3)}"]
    out = []
    for kind, made in [*((k, f) for k, fs in forms.items() for f in fs), *(("outside", f) for f in alike)]:
        for _ in range(n):
            before = " ".join(word() for _ in range(rng.randint(0, 3)))
            before = before + rng.choice((" ", ": ", " (", ". ")) if before and kind != "email" else before and before + ", "
            middle, end = made(), rng.choice((" " + word(), ".", ", " + word(), "", ". " + word()))
            span = [(len(before), len(before) + len(middle), kind)] if kind != "outside" else []
            out.append((before + middle + end, span))
    return out


def regions(text: str, covered: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Stretches around triggers that no rule has covered, and from where to where spans of theirs may start."""
    covered = sorted(covered)
    spots, c = [], 0
    for m in TRIGGER.finditer(text):
        while c < len(covered) and covered[c][1] <= m.start():
            c += 1
        if c == len(covered) or m.start() < covered[c][0]:
            spots.append(m.start())
    i, free, own = 0, 0, 0
    while i < len(spots):
        start = max(free, spots[i] - AROUND)
        j = i
        while j + 1 < len(spots) and spots[j + 1] - spots[j] < AROUND and spots[j + 1] - start < REGION - AROUND:
            j += 1
        end = min(len(text), spots[j] + 1 + AROUND)
        blank = text.find(" ", spots[j], end) if end < len(text) else -1
        end = max(text.rfind(" ", spots[j], end), spots[j] + 1) if blank >= 0 else end
        if j + 1 < len(spots) and spots[j + 1] - spots[j] < AROUND:
            last = end - OVERLAP
            yield start, end, max(start, own), last
            own, free = last, last - OVERLAP
            free = max(free - AROUND, text.rfind(" ", free - AROUND, free) + 1) if " " in text[free - AROUND:free] else free
            i = bisect_left(spots, free)
        else:
            yield start, end, max(start, own), end
            own, free, i = end, end, j + 1


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Weights:
    """Fit on written-out forms and a bounded sample of places labelled by the rules."""
    total = max(1, docs.count())
    drawn = docs.select(F.xxhash64(F.lit("pii"), id_col).alias("draw"), F.col(text_col).alias("text")).filter(
        F.col("draw") <= hash_limit(SAMPLE_TEXTS, total))

    def places(batches):
        for batch in batches:
            out = {"draw": [], "text": [], "entities": []}
            for draw, text in zip(batch.column("draw").to_pylist(), strings(batch.column("text"))):
                spans = base_spans(text)
                flat = sorted((a, b, kind) for kind, s in spans.items() for a, b in s)
                for a, b, _, _ in regions(text, []):
                    held = [x for x in flat if a <= x[0] and x[1] <= b]
                    if all(x[1] <= y[0] for x, y in zip(held, held[1:])):
                        out["draw"].append(draw)
                        out["text"].append(text[a:b])
                        out["entities"].append(",".join(f"{x - a}:{y - a}:{k}" for x, y, k in held))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("draw", pa.int64()), ("text", pa.string()), ("entities", pa.string())]))

    rows = (drawn.mapInArrow(places, "draw long, text string, entities string")
            .orderBy("draw", "text").limit(sample).collect())
    found = [(r.text, [(int(a), int(b), k) for a, b, k in (e.split(":") for e in r.entities.split(",") if e)])
             for r in rows]
    return fit(found + written_examples())


def all_spans(text: str, weights: Weights) -> tuple[dict, dict]:
    """Spans of the rules, and with what the random field adds."""
    base = base_spans(text)
    covered = [span for spans in base.values() for span in spans]
    every = {kind: list(spans) for kind, spans in base.items()}
    free = 0
    for a, b, first, last in regions(text, covered):
        near = [s for s in covered if s[1] > a and s[0] < b]
        for x, y, kind in sorted(best_path(Lattice(text, a, b, near), weights)):
            if max(first, free) <= x < last:
                every[kind].append((x, y))
                free = y
    return base, every


ADDED = [("n_email", T.LongType()), ("n_ip", T.LongType()), ("n_card", T.LongType()),
         ("n_phone", T.LongType()), ("base_spans", T.StringType()), ("spans", T.StringType()),
         ("redacted", T.StringType())]


def redact(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """Every span replaced by its kind; overlapping ones by the first."""
    out, at = [], 0
    for a, b, kind in sorted((a, -b, kind) for kind, s in spans.items() for a, b in s):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, -b)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, weights: Weights, text_col: str = "text",
                       redacted: bool = True) -> DataFrame:
    """All columns of ``docs``, counts and spans of the rules, all spans, and the text without them."""
    added = ADDED if redacted else ADDED[:-1]
    kept = [f for f in docs.schema.fields if f.name not in {n for n, _ in added}]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in added])

    def run(batches):
        for batch in batches:
            out = {n: [] for n, _ in added}
            for text in batch.column(text_col).to_pylist():
                base, every = all_spans(text or "", weights)
                for kind in KINDS:
                    out[f"n_{kind}"].append(len(base[kind]))
                out["base_spans"].append(digest(base))
                out["spans"].append(digest(every))
                if redacted:
                    out["redacted"].append(None if text is None else redact(text, every))
            columns = [pa.array(out[n], pa.int64() if n.startswith("n_") else pa.string()) for n, _ in added]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + columns,
                                             names=[f.name for f in schema.fields])

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_personal_data(docs, learn(docs), redacted=False).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"),
        "spans")
