"""Benchmark passages in documents, also reworded ones, by latent semantic retrieval.

Passages are 32 words, one begun at each 16th word of a document. Terms are weighted by tf-idf, the
passage frequencies being counted over all documents, the idf between 1 (in all passages) and
``MOST_IDF``: as an item's words are common where its copies are, none may outweigh the others
by far. Items are cut evenly into pieces of at most ``PIECE`` words, which a passage can cover
in good part; the pieces are what is searched. A randomised singular value decomposition of the benchmark's
pieces, each of unit length, its products summed up over the tasks, gives the latent space: pieces of at most
``ITEMS_AT_ONCE`` items are searched at a time, and the space has as few of the main directions as leave every piece
``KEPT`` of its square, so words that pieces have together stand for one another and no piece is lost. Every passage
of every document is folded in and its cosine with every piece in the space
taken (a stated query set against all rows, in blocks); the passage's whole length counts, words that no item has
among it, and what the space keeps of a piece counts as all of it, so that the piece's own cosine is 1.
Where that is at least ``COSINE``, windows of the document around the passage are compared with the piece's
item, if they have enough words in common with it, in any order, for what follows to be possible: the longest
common subsequence, as a share of the item, and that of the item's answer (what follows the last question mark or
"answer:", else its last sentence). A window is twice as long as the item and a quarter more.

A document leaks an item if the common subsequence is at least ``VERBATIM``, or at least
``REWORDED`` with at least ``ANSWERED`` of the answer.

Defined cases: a text that is null or has no words leaks nothing, and an item without words is
never leaked; items of one text are items of their own. Repeated rows are marked one by one. All columns of the documents are kept
but one named like the added one.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litsearch.llm.common import (NOT_ALPHANUMERIC, groups, joined_bytes, lower_ascii, run_starts, strings, table,
                                  word_hashes, word_spans)

STEP = 16  # words from one passage to the next; a passage is two steps long
ITEMS_AT_ONCE, PIECES_AT_ONCE, POWER, EXTRA, SEED = 256, 512, 2, 8, 11
PIECE, MOST_IDF, COSINE, KEPT = 48, 4.0, 0.2, 0.5
VERBATIM, REWORDED, ANSWERED = 0.75, 0.5, 0.8
#: A copy may be as long as so many lengths of its item; windows of it begin at so many places of a length.
REACH, PER_LENGTH = 2, 4
#: Less than this is rounding of the decomposition, or of products in single precision.
ROUNDING = 1e-5
#: Terms folded in by their counts, and the unit of places in the space: 2 * STEP * MOST_IDF of it are below 2^24.
USUAL, EXACT = 128, 2**16
#: Sections that bound the words in common begin so often in the surroundings of the longest item.
HOPS = 3
CHARS_AT_ONCE, TERMS_AT_ONCE, PAIRS_AT_ONCE, BLOCKS_AT_ONCE = 250_000, 64, 1024, 8
LEAKS = "array<struct<item_id:long,cosine:double,lcs:double,answer:double>>"
ANSWER = re.compile(r".*(?:\?|\banswer\s*:)", re.S | re.I)
SENTENCE = re.compile(r"[.!?\n]+")


def hashed_words(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (letters and digits, in small letters) and each text's first word."""
    data, starts = joined_bytes(values)
    data = lower_ascii(data)
    begin, end, first = word_spans(data, starts, NOT_ALPHANUMERIC)
    return word_hashes(data, begin, end), first


def answer_of(text: str) -> str:
    marked = ANSWER.match(text)
    if marked and text[marked.end():].strip():
        return text[marked.end():]
    return next((s for s in reversed(SENTENCE.split(text)) if s.strip()), "")


class Items:
    """At most ITEMS_AT_ONCE benchmark passages, of PIECES_AT_ONCE pieces or one passage, and their vocabulary."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids = [i for i, _ in rows]
        words, first = hashed_words([t for _, t in rows])
        self.words = [words[a:b] for a, b in zip(first[:-1], first[1:])]
        words, first = hashed_words([answer_of(t) for _, t in rows])
        self.answers = [words[a:b] for a, b in zip(first[:-1], first[1:])]
        self.terms = np.unique(np.concatenate([*self.words, np.zeros(0, np.uint64)]))
        cut = [np.array_split(words, pieces_of(len(words))) for words in self.words]
        self.pieces = [piece for pieces in cut for piece in pieces]
        self.item = np.repeat(np.arange(len(cut)), [len(pieces) for pieces in cut])  # of each piece

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Number of each word in the vocabulary, -1 if it is not there."""
        return places_in(self.terms, words)

    def matrix(self, weight: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.pieces), len(self.terms)))
        for row, words in zip(out, self.pieces):
            np.add.at(row, self.lookup(words), 1)
        return out * weight

    def unit(self, weight: np.ndarray) -> np.ndarray:
        """The same with rows of length 1, those without words being zero."""
        out = self.matrix(weight)
        size = np.linalg.norm(out, axis=1)
        return out / np.where(size > 0, size, 1)[:, None]


def pieces_of(words: int) -> int:
    return max(1, -(-words // PIECE))


def steps_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Step of every word, numbered through all texts; each text's first step; text of every word."""
    n = np.diff(first)
    start = np.concatenate(([0], np.cumsum(-(-n // STEP))))
    text = np.repeat(np.arange(len(n)), n)
    return start[text] + (np.arange(first[-1]) - first[text]) // STEP, start, text


def passage_sums(start: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are passages, and for each row its sum with the next.

    There is a row for each step and an empty one behind each text, so that no sum spans two texts.
    """
    n = np.diff(start)
    is_passage = np.zeros(len(sums) - 1, bool)
    is_passage[padded(start, np.arange(start[-1]))] = True
    ends = (start[1:] - 1 + np.arange(len(n)))[n > 1]
    is_passage[ends] = False  # a text's last step is the second half of the passage before
    return is_passage, sums[:-1] + sums[1:]


def padded(start: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Row of a step, with an empty row behind each text."""
    return steps + text_of_step(start, steps)


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All whole numbers of the runs."""
    return np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)


def places_in(terms: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Number of each word among sorted terms, -1 if it is not there."""
    if not len(terms):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
    return np.where(terms[at] == words, at, -1)


def passage_counts(docs: DataFrame, terms: np.ndarray, text_col: str) -> tuple[np.ndarray, int]:
    """In how many passages of all documents each term is, and how many passages there are."""

    def count(batches):
        total, seen = 0, np.zeros(len(terms), np.int64)
        for batch in batches:
            for group in groups(strings(batch.column("text")), CHARS_AT_ONCE):
                words, first = hashed_words(group)
                step, start, text = steps_of(first)
                n = np.diff(start)
                total += int(np.maximum(n - 1, np.minimum(n, 1)).sum())
                term = places_in(terms, words)
                at = np.flatnonzero(term >= 0)
                term, step, text = term[at], step[at], text[at]
                as_first = (step < start[text + 1] - 1) | (step == start[text])
                as_second = step > start[text]
                pair = np.concatenate((step[as_first], step[as_second] - 1)) * len(terms)
                pair = np.sort(pair + np.concatenate((term[as_first], term[as_second])))
                seen += np.bincount(pair[run_starts(pair)] % max(1, len(terms)), minlength=len(terms))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(seen)), pa.int32()), pa.array(np.append(total, seen), pa.int64())],
            names=["term", "n"])

    # a task sends a row for each term of at most ITEMS_AT_ONCE * BLOCKS_AT_ONCE items
    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(count, "term int, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(len(terms) + 1, np.int64)
    out[rows["term"].to_numpy() + 1] = rows["n"]
    return out[1:], int(out[0])


def add_up(blocks: pa.Table) -> pa.Table:
    """Sum of the blocks of one place."""
    total = sum(np.frombuffer(rows) for rows in blocks["rows"].to_pylist())
    return pa.table({"first": blocks["first"][:1], "rows": pa.array([total.tobytes()], pa.binary())})


def latent_space(benchmark: DataFrame, items: Items, weight: np.ndarray, kept: float = 1) -> np.ndarray:
    """Orthonormal terms x dimensions by randomised SVD; products with the matrix are Spark jobs. As few of the main
    dimensions as leave each piece that share of its square."""
    size = min(len(items.pieces), len(items.terms))
    if not size:
        return np.zeros((len(items.terms), 0))
    basis = np.random.default_rng(SEED).standard_normal((len(items.terms), min(len(items.terms), size + EXTRA)))
    for _ in range(POWER + 1):
        basis = np.linalg.qr(basis)[0]

        def product(batches):
            out = np.zeros_like(basis)
            for batch in batches:
                part = Items([(0, t) for t in strings(batch.column("text"))])
                for words in part.pieces:
                    row = np.bincount(items.lookup(words), minlength=len(items.terms)) * weight
                    out += np.outer(row, row @ basis) / max(row @ row, ROUNDING)
            first = list(range(0, len(out), TERMS_AT_ONCE))
            yield pa.RecordBatch.from_arrays(
                [pa.array(first, pa.int32()),
                 pa.array([out[a:a + TERMS_AT_ONCE].tobytes() for a in first], pa.binary())],
                names=["first", "rows"])

        # terms x dimensions in blocks of rows: at most ITEMS_AT_ONCE items hold them
        summed = (benchmark.select("text").mapInArrow(product, "first int, rows binary")
                  .groupBy("first").applyInArrow(add_up, "first int, rows binary").collect())
        basis = np.concatenate([np.frombuffer(r.rows).reshape(-1, basis.shape[1])
                                for r in sorted(summed, key=lambda r: r.first)])
    left, _, _ = np.linalg.svd(basis, full_matrices=False)
    share = np.cumsum((items.unit(weight) @ left[:, :size]) ** 2, axis=1)
    short = share[[len(words) > 0 for words in items.pieces]].min(axis=0) < kept - ROUNDING
    return left[:, :min(size, int(short.sum()) + 1)]


def places_of(words: np.ndarray) -> dict[int, int]:
    """A bit for each place of each word."""
    places: dict[int, int] = {}
    for i, x in enumerate(words.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    return places


def common_with(places: dict[int, int], n: int, b: list[int]) -> int:
    whole = rest = (1 << n) - 1
    for x in b:
        if x in places:
            taken = rest & places[x]
            rest = (rest + taken | rest - taken) & whole
    return n - rest.bit_count()


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    return common_with(places_of(a), len(a), b.tolist())


class Block:
    """Items searched together in their latent space: a word adds its row of ``fold`` to a passage's place there,
    whose product with a piece's row of ``near`` is 1 if the passage is the piece at unit length."""

    def __init__(self, items: Items, weight: np.ndarray, space: np.ndarray):
        self.items, self.weight = items, weight
        latent = items.unit(weight) @ space
        share = (latent ** 2).sum(axis=1)
        # so many digits that a passage's sums are exact in single precision, in any order
        self.fold = np.rint(weight[:, None] * space * EXACT).astype(np.float32) / EXACT
        self.usual = np.argsort(weight, kind="stable")[:USUAL]  # terms that most words are
        self.place = np.full(len(weight), -1)
        self.place[self.usual] = np.arange(len(self.usual))
        self.near = (latent / np.where(share > 0, share, 1)[:, None]).astype(np.float32)
        self.held = np.zeros((len(items.words), len(items.terms)), np.uint16)  # words of each item
        for row, words in zip(self.held, items.words):
            np.add.at(row, items.lookup(words), 1)
        self.length = np.array([len(w) for w in items.words])
        # of each term the items, holder[first[t]:first[t + 1]], and how often they hold it
        word, self.holder = np.nonzero(self.held.T)
        self.times = self.held[self.holder, word]
        self.first = np.searchsorted(word, np.arange(len(weight) + 1))

    def candidates(self, term: np.ndarray, step: np.ndarray, start: np.ndarray, text: np.ndarray):
        """Passage, item and cosine of all pairs whose cosine may reach ``COSINE``, but for those whose surroundings
        have too few words of the item.

        The passage's length is taken as if none of its words were repeated, and is then never more than the true
        one; so the cosine is never less.
        """
        if not len(term):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        at, rows = np.flatnonzero(term >= 0), int(start[-1]) + len(start)
        row, usual = step + text, self.place[term[at]]
        n = np.bincount(row[at[usual >= 0]] * len(self.usual) + usual[usual >= 0], minlength=rows * len(self.usual))
        place = n.reshape(rows, len(self.usual)).astype(np.float32) @ self.fold[self.usual]
        rare = at[usual < 0]
        run = run_starts(row[rare])
        rank = np.arange(len(rare)) - np.repeat(run, np.diff(np.append(run, len(rare))))
        for i in range(STEP):  # the i-th such word of every step
            word = rare[rank == i]
            place[row[word]] += self.fold[term[word]]
        square = np.full(len(term), MOST_IDF**2)
        square[at] = self.weight[term[at]] ** 2
        is_passage, place = passage_sums(start, place)
        norm = np.sqrt(passage_sums(start, np.bincount(row, square, minlength=rows))[1])
        least = np.where(is_passage, (COSINE - ROUNDING) * norm, np.inf).astype(np.float32)
        p, k = np.divmod(np.flatnonzero(place @ self.near.T >= least[:, None]), len(self.near))
        doc, item = text_of_row(start, np.arange(rows))[p], self.items.item[k]
        passage = p - doc
        near, section = self.common_at_most(term, step, start, text)
        enough = near[section(passage, doc, item), item] >= REWORDED * self.length[item]
        p, k, passage, item = p[enough], k[enough], passage[enough], item[enough]
        # products again, as those above depend in their last digits on what texts are in the group
        cosine = np.zeros(len(p))
        for a in range(0, len(p), PAIRS_AT_ONCE):
            b = slice(a, a + PAIRS_AT_ONCE)
            cosine[b] = (place[p[b]].astype(float) * self.near[k[b]]).sum(axis=1) / norm[p[b]]
        order = np.lexsort((-cosine, item, p))  # of an item's pieces the nearest
        order = order[cosine[order] >= COSINE]
        first = order[run_starts(passage[order] * len(self.length) + item[order])]
        return passage[first], item[first], np.minimum(cosine[first], 1)

    def common_at_most(self, term: np.ndarray, step: np.ndarray, start: np.ndarray, text: np.ndarray):
        """Words that each section of the texts has in common with each item, in any order, and a function for the
        section that holds a passage's surroundings, where a copy of the item would be. One begins at each hop; it is
        ``HOPS`` hops and one more long, and the surroundings are at most a step longer than ``HOPS``."""
        reach = -(-REACH * self.length // STEP)
        hop = -(-(2 * int(reach.max()) + 1) // HOPS)
        begin = np.concatenate(([0], np.cumsum(-(-np.diff(start) // hop))))
        at, terms, items = np.flatnonzero(term >= 0), max(1, len(self.weight)), len(self.length)
        own = (step[at] - start[text[at]]) // hop
        key = (begin[text[at]] + own) * terms + term[at]
        key, n = np.unique(np.concatenate([key[own >= i] - i * terms for i in range(HOPS + 1)]), return_counts=True)
        section, word = np.divmod(key, terms)
        size = np.diff(self.first)[word]
        entry = ranges(self.first[word], size)
        least = np.bincount(np.repeat(section * items, size) + self.holder[entry],
                            np.minimum(np.repeat(n, size), self.times[entry]), minlength=int(begin[-1]) * items)
        return (least.reshape(-1, items),
                lambda passage, doc, item: begin[doc] + np.maximum(passage - start[doc] - reach[item], 0) // hop)

    def common_words(self, term: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Words that each item has in common with the words from ``low`` to ``high``, in any order:
        the longest common subsequence has no more."""
        known = np.flatnonzero(term >= 0)
        low, high, word_at = np.searchsorted(known, low), np.searchsorted(known, high), term[known]
        out = np.zeros(len(item), np.int64)
        for a in range(0, len(item), PAIRS_AT_ONCE):
            begin, size, items = low[a:a + PAIRS_AT_ONCE], (high - low)[a:a + PAIRS_AT_ONCE], item[a:a + PAIRS_AT_ONCE]
            key = np.repeat(np.arange(len(size)) * len(self.items.terms), size) + word_at[ranges(begin, size)]
            held = self.held.ravel()[key + np.repeat((items - np.arange(len(size))) * len(self.items.terms), size)]
            key, n = np.unique(key[held > 0], return_counts=True)
            pair, word = np.divmod(key, max(1, len(self.items.terms)))
            out[a:a + PAIRS_AT_ONCE] = np.bincount(pair, np.minimum(n, self.held[items[pair], word]), minlength=len(size))
        return out


def text_of_step(start: np.ndarray, steps: np.ndarray) -> np.ndarray:
    return np.searchsorted(start, steps, "right") - 1


def text_of_row(start: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.searchsorted(start + np.arange(len(start)), rows, "right") - 1


def windows(doc: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray, cosine: np.ndarray,
            first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same in windows, so that words from far apart make no copy: ``REACH`` lengths of the item and a step
    wide, one begun at each step, ``1 / PER_LENGTH`` of it. A copy of up to ``REACH`` lengths lies whole in one."""
    step = -(-length[item] // PER_LENGTH)
    begin = (low - first[doc]) // step
    n = np.maximum(-(-(high - first[doc] - REACH * length[item]) // step) - begin, 1)
    row = np.repeat(np.arange(len(doc)), n)
    at = ranges(begin, n)
    order = np.lexsort((-cosine[row], at, item[row], doc[row]))
    row, at = row[order], at[order]
    new = np.ones(len(row), bool)
    new[1:] = (doc[row[1:]] != doc[row[:-1]]) | (item[row[1:]] != item[row[:-1]]) | (at[1:] != at[:-1])
    row, at = row[new], at[new]
    doc, item = doc[row], item[row]
    low = first[doc] + at * step[row]
    return doc, item, low, np.minimum(low + REACH * length[item] + step[row], first[doc + 1]), cosine[row]


def find_leaks(values: list[str], blocks: list[Block]) -> list[dict[tuple, dict]]:
    """Of each text: the items it leaks."""
    out: list[dict[tuple, dict]] = [{} for _ in values]
    words, first = hashed_words(values)
    step, start, text = steps_of(first)
    for number, block in enumerate(blocks):
        items = block.items
        term = items.lookup(words)
        passage, item, cosine = block.candidates(term, step, start, text)
        doc = text_of_step(start, passage)
        place, reach = first[doc] + (passage - start[doc]) * STEP, REACH * block.length[item]
        low, high = np.maximum(first[doc], place - reach), np.minimum(first[doc + 1], place + 2 * STEP + reach)
        enough = block.common_words(term, low, high, item) >= REWORDED * block.length[item]
        doc, item, low, high, cosine = windows(doc[enough], item[enough], low[enough], high[enough], cosine[enough],
                                               first, block.length)
        enough = block.common_words(term, low, high, item) >= REWORDED * block.length[item]
        places: dict[int, dict[int, int]] = {}
        best = np.argsort(-cosine[enough], kind="stable")
        for d, i, a, b, near in zip(*(x[enough][best].tolist() for x in (doc, item, low, high, cosine))):
            had = out[d].get((number, i))
            if had is not None and had["lcs"] == 1:
                continue
            around, n = words[a:b].tolist(), len(items.words[i])
            if i not in places:
                places[i] = places_of(items.words[i])
            share = common_with(places[i], n, around) / n
            if share < REWORDED or had is not None and had["lcs"] >= share:
                continue
            answer = items.answers[i]
            found = common_with(places_of(answer), len(answer), around) / len(answer) if len(answer) else 0.0
            if share >= VERBATIM or found >= ANSWERED:
                out[d][number, i] = {"item_id": items.ids[i], "cosine": round(near, 6), "lcs": share, "answer": found}
    return out


def search(docs: DataFrame, blocks: list[Block], text_col: str, column: str) -> DataFrame:
    """``docs`` with the leaks of these blocks' items added to those in ``column``."""
    schema = docs.schema

    def run(batches):
        for batch in batches:
            found = []
            for group in groups(strings(batch.column(text_col)), CHARS_AT_ONCE):
                found += find_leaks(group, blocks)
            old = batch.column(column).to_pylist()
            both = pa.array([[*(a or []), *(b[i] for i in sorted(b))] for a, b in zip(old, found)],
                            pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()),
                                                ("lcs", pa.float64()), ("answer", pa.float64())])))
            yield pa.RecordBatch.from_arrays(
                [both if f.name == column else batch.column(f.name) for f in schema.fields],
                names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def mark_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", column: str = "leaks") -> DataFrame:
    """All columns of ``docs`` and the benchmark items each text leaks."""
    kept = [f for f in docs.schema.fields if f.name != column]
    marked = docs.select(*[F.col(f"`{f.name}`") for f in kept],
                         F.lit(None).cast(T._parse_datatype_string(LEAKS)).alias(column))
    named = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    marked = marked.withColumn(column, F.coalesce(column, F.array().cast(LEAKS)))
    held: list[list[tuple[int, str]]] = []
    pieces = 0
    for row in named.orderBy("item_id", "text").toLocalIterator():
        more = pieces_of(len(hashed_words([row.text])[0]))
        if not held or len(held[-1]) == ITEMS_AT_ONCE or pieces + more > PIECES_AT_ONCE:
            if len(held) == BLOCKS_AT_ONCE:
                marked = search(marked, make_blocks(docs, held, text_col), text_col, column)
                held = []
            held.append([])
            pieces = 0
        held[-1].append((row.item_id, row.text))
        pieces += more
    return search(marked, make_blocks(docs, held, text_col), text_col, column) if held else marked


def make_blocks(docs: DataFrame, rows: list[list[tuple[int, str]]], text_col: str) -> list[Block]:
    """Blocks of these items, each with its latent space. Terms of all are counted in one pass over the documents
    as they were given, so no search runs again for it."""
    items = [Items(part) for part in rows]
    terms = np.unique(np.concatenate([x.terms for x in items]))
    seen, total = passage_counts(docs, terms, text_col)
    weight = np.minimum(np.log((total + 1) / (seen + 1)) + 1, MOST_IDF)
    blocks = []
    for part, own_rows in zip(items, rows):
        block = docs.sparkSession.createDataFrame(pa.table({"text": [t for _, t in own_rows]}))
        own = weight[places_in(terms, part.terms)]
        blocks.append(Block(part, own, latent_space(block, part, own, KEPT)))
    return blocks


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and item it leaks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (mark_leaks(docs, table(spark, sf_dir, "benchmark"))
            .select("doc_id", F.inline("leaks")))
