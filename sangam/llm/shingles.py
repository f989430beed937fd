"""Word shingles as 64-bit hashes, the same in every process, and sets of them."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import may_hold, membership, small_slices

#: As ``common.WORD``, over UTF-8 bytes: all the characters left out are ASCII.
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
#: Word hashes remembered per worker; emptied when full. A text's own words come on top.
_REMEMBERED = 50_000
_seen: dict[bytes, int] = {}
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def lower_words(text: str | None) -> list[bytes]:
    """Words in UTF-8, with A-Z in lower case and nothing else changed; none for null."""
    return _WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_seen) > _REMEMBERED:
        _seen.clear()
    out = list(map(_seen.get, words))
    if None in out:
        for word in {word for word, found in zip(words, out) if found is None}:
            _seen[word] = xxhash.xxh64_intdigest(word)
        out = list(map(_seen.__getitem__, words))
    return np.array(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words in order; of fewer words, one hash of them all."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for place in range(size):
        factor = np.uint64(pow(_ODD, place + 1, 1 << 64))
        out += words[place : len(words) - size + 1 + place] * factor
    return mix(out + np.uint64(size))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; one of the whole for fewer words, none without words."""
    return np.unique(shingle_hashes(word_hashes(lower_words(text)), size))


def digest_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def common_count(a: np.ndarray, b: np.ndarray) -> int:
    """Values that two sorted arrays of distinct values have in common."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def with_texts(points: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``points`` with the text of each; texts that are of no point stay where they are, repeated rows count once."""
    wanted = membership(points.select("node"))

    def useful(incoming):
        for batch in (part for whole in incoming for part in small_slices(whole)):
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(known & may_hold(wanted.value, ids.fill_null(0).to_numpy())))
            digests = [digest_of(shingle_set(t, size)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], names=["node", "text", "digest"])

    texts = docs.mapInArrow(useful, "node long, text string, digest binary").dropDuplicates(["node", "digest"])
    return points.join(texts, ["node", "digest"])
