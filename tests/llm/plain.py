"""Plain versions that several tests use."""

import base64
from functools import lru_cache

import public_tokenizers
import tiktoken

from litsearch.llm.op6_pii import KINDS
from test_op6 import plain_spans
from test_op9 import plain_components, plain_fingerprint


def plain_base_spans(text):
    found = plain_spans(text)
    return [span for kind in KINDS for span in found[kind]]


def plain_groups(rows):
    """Sets of ids linked by fingerprints."""
    known = plain_components([i for i, _ in rows], [plain_fingerprint(t) for _, t in rows])
    groups = {}
    for i, least in known.items():
        groups.setdefault(least, set()).add(i)
    return list(groups.values())


@lru_cache(maxsize=1)
def library(path):
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def tiktoken_ids(path, text):
    return library(path).encode_ordinary(text)
