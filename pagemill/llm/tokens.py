"""Token ids of whole Arrow batches by a public tokenizer.

Texts are cut where white space follows a printing character, a mark follows an ASCII letter
or digit, or one of these follows a lone line break. The byte-level pattern never matches
across such a place and looks at nothing before its match, so the ids of the parts are those
of the text; equal parts of a block are encoded once.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from pagemill.llm.words import SPACED, utf8

# Bytes of text encoded at a time; a document above it is a block of its own.
BLOCK_BYTES = 1 << 24
# Parts encoded in one call: the library holds some 500 bytes for each.
BATCH = 1 << 16

_BYTES = np.arange(256)
_ALNUM = np.array([chr(b).isascii() and chr(b).isalnum() for b in _BYTES])
_MARK = (_BYTES > 0x20) & (_BYTES < 0x7F) & ~_ALNUM


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=1)
def load(path: str) -> tuple[Tokenizer, np.ndarray | None]:
    """The tokenizer, and the marks before which its texts may be cut, if they may be cut at all;
    loaded once in each worker."""
    # A worker is one task's process: threads of its own would take the other tasks' cores.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    parts = json.loads(tokenizer.to_str())
    before = parts["pre_tokenizer"] or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    bare = not any(parts[k] for k in ("normalizer", "truncation", "padding"))
    added = [t["content"] for t in parts["added_tokens"]]
    whole = not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"])
    # No cut within an added token.
    marks = _MARK.copy()
    marks[list(set("".join(added).encode()))] = False
    return tokenizer, marks if plain and bare and whole and not any(set(t) & set(" \t\n\v\f\r") for t in added) else None


def part_starts(data: np.ndarray, bounds: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """First bytes of the parts of all documents ``data[bounds[d]:bounds[d + 1]]``."""
    printing = (data > 0x20) & (data != 0x7F)
    # White space beyond ASCII is led by C2, or is three bytes from E1 to E3.
    printing[1:] &= data[:-1] != 0xC2
    printing[2:] &= (data[:-2] < 0xE1) | (data[:-2] > 0xE3)
    blank, alnum = ~SPACED[data], _ALNUM[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = printing[:-1] & blank[1:]
    # A lone line break stays apart from the word behind it, and a word from a mark behind it.
    cut[2:] |= printing[:-2] & (data[1:-1] == 0x0A) & alnum[2:]
    cut[1:] |= alnum[:-1] & marks[data[1:]]
    cut[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    return np.flatnonzero(cut)


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``values[starts[i] : starts[i] + counts[i]]`` of all ``i`` in one array."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


def encode_each(tokenizer: Tokenizer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each text has, and all of them."""
    sizes, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for lo in range(0, len(texts), BATCH):
        found = tokenizer.encode_batch_fast(texts.slice(lo, BATCH).to_pylist(), add_special_tokens=False)
        ids = [e.ids for e in found]
        sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat.append(np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes[-1].sum())))
    return np.concatenate(sizes), np.concatenate(flat)


def encoded(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``lo, hi, ids, first``: document ``d`` of ``lo`` up to ``hi`` has the ids
    ``ids[first[d - lo]:first[d - lo + 1]]``. A null text is empty."""
    tokenizer, marks = load(path)
    data, offsets = utf8(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK_BYTES, side="right")) - 1)
        bounds = offsets[lo : hi + 1] - offsets[lo]
        piece = data[offsets[lo] : offsets[hi]]
        if marks is not None and len(piece):
            starts = part_starts(piece, bounds, marks)
        else:
            starts = bounds[:-1][bounds[:-1] < bounds[1:]]
        ends = np.append(starts, len(piece)).astype(np.int64)
        parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(piece)))
        coded = parts.dictionary_encode()
        sizes, flat = encode_each(tokenizer, coded.dictionary)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        counts = sizes[codes]
        ids = gather(flat, (np.cumsum(sizes) - sizes)[codes], counts)
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        yield lo, hi, ids, before[np.searchsorted(starts, bounds)]
        lo = hi
