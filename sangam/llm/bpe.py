"""Byte-level BPE as a streaming transducer, and the inverse as a byte-to-text state machine.

A text is read in slices. Cuts into pieces (the vocabulary's pattern) are made as soon as
no further character can change them. Within a piece, one token is kept for every prefix: the
last one of that prefix's encoding. A token can follow another only if merging the bytes of both
by the merge list gives the two back, and just one token fits at each prefix, so the next
prefix needs nothing but the tokens of the last ``lookahead`` prefixes, ``lookahead`` being
the longest product of the merge list in bytes. Tokens on which the paths from all those prefixes
agree can't change any more and are emitted; the rest is all the memory a piece needs,
however long it is.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from itertools import chain

import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import arrow_rows, table

#: Fixed value: the pattern of this kind of vocabulary.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: The same cuts for texts of ASCII and Latin letters alone, and a test for those.
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_LATIN_PATTERN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^{_LATIN}0-9 \t\n\v\f\r]+|[ \t\n\v\f\r]+(?![^ \t\n\v\f\r])|[ \t\n\v\f\r]+"
)
_LATIN_TEXT = re.compile(r"[\x00-\x7FÀ-ÖØ-öø-ÿ]*")
#: How a piece of one kind goes on.
_RUNS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"\s+", r"[^\s\p{L}\p{N}]+")]
_SPACES = _RUNS[2]
#: Characters that may still change how a piece before them is cut.
_UNSURE = 3
SLICE_CHARS = 1 << 16
LONG_PIECE = 4096
#: Pieces and pairs remembered per worker.
_REMEMBERED = 250_000


def byte_letters() -> dict[str, int]:
    """Vocabulary files write each byte as a letter: printable ones as such, others from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(b): b for b in printable}
    others = (b for b in range(256) if b not in letters.values())
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file."""

    def __init__(self, text: str):
        file = json.loads(text)
        letters = byte_letters()
        spelled = {t: bytes(letters[c] for c in t) for t in file["model"]["vocab"]}
        self.ids = {spelled[t]: i for t, i in file["model"]["vocab"].items()}
        self.bytes = {i: b for b, i in self.ids.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        self.merges = {}
        for rank, (a, b) in enumerate(pairs):
            product = self.ids[spelled[a] + spelled[b]]
            self.merges[self.ids[spelled[a]], self.ids[spelled[b]]] = (rank, product)
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.added.items()}
        self.texts = {i: str(i) for i in self.bytes}
        #: Sufficient lookahead in bytes: no token reaches further.
        self.lookahead = max(map(len, self.ids))
        self._spines: dict[int, tuple] = {}
        self._made = {product: (rank, a, b) for (a, b), (rank, product) in self.merges.items()}
        for rank, a, b in self._made.values():
            if any(part in self._made and self._made[part][0] >= rank for part in (a, b)):
                raise ValueError("a merge comes before the merges that its parts are made by")
        self.pairs: dict[tuple[int, int], bool] = {}  # what ``fits`` has found
        self.pieces: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def merged(self, data: bytes) -> list[int]:
        """The merge procedure as such, quadratic: what everything else must agree with."""
        ids = [self.ids[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            best = min((self.merges.get(pair, (len(self.merges), -1)) for pair in zip(ids, ids[1:])))
            if best[1] < 0:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and self.merges.get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _spine(self, token: int) -> tuple:
        """What stands at the token's right edge while it is made, and at its left edge: (id, rank that ends it), last first."""
        found = self._spines.get(token)
        if found is None:
            sides = []
            for side in (2, 1):
                spine, part = [(token, len(self.merges))], token
                while part in self._made:
                    rank, part = self._made[part][0], self._made[part][side]
                    spine.append((part, rank))
                sides.append(tuple(spine))
            found = self._spines[token] = tuple(sides)
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left`` in an encoding.

        Merges happen in the order of their ranks, so it can't if some merge across the border comes while both its
        parts stand there. Of two merges of one rank, that to the left comes first.
        """
        known, merges = self.pairs, self.merges
        if len(known) >= 4 * _REMEMBERED:
            known.clear()
        found = True
        for a, until_a in self._spine(left)[0]:
            for b, until_b in self._spine(right)[1]:
                merge = merges.get((a, b))
                if merge is not None and merge[0] < until_a and merge[0] <= until_b:
                    found = False
                    break
        known[left, right] = found
        return found

    def remember(self, piece: str, ids: tuple[int, ...]) -> None:
        """Keeps at least the last ``_REMEMBERED`` pieces looked up for the first time, and twice as many at most."""
        if len(self.pieces) >= _REMEMBERED:
            self._older = self.pieces
            self.pieces = {}
        self.pieces[piece] = ids

    def recalled(self, piece: str) -> tuple[int, ...] | None:
        found = self._older.get(piece)
        if found is not None:
            self.remember(piece, found)
        return found


class Piece:
    """The transducer within one piece: bytes go in, tokens come out once stable."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.data = b""
        self.last: list[int | None] = [None]  # by prefix of data: last token; at 0 the last one emitted

    def _extend(self, data: bytes) -> None:
        ids, known, fits, last = self.v.ids, self.v.pairs, self.v.fits, self.last
        self.data += data
        whole, reach = self.data, self.v.lookahead
        for end in range(len(last), len(whole) + 1):
            for start in range(max(0, end - reach), end):
                token = ids.get(whole[start:end])
                if token is not None:
                    before = last[start]
                    good = before is None or known.get((before, token))
                    if good or good is None and fits(before, token):
                        last.append(token)
                        break

    def _path(self, end: int) -> list[int]:
        out = []
        while end:
            out.append(self.last[end])
            end -= len(self.v.bytes[out[-1]])
        return out[::-1]

    def push(self, data: bytes) -> list[int]:
        self._extend(data)
        ends = set(range(max(0, len(self.data) - self.v.lookahead + 1), len(self.data) + 1))
        while len(ends) > 1:
            end = max(ends)
            ends.remove(end)
            ends.add(end - len(self.v.bytes[self.last[end]]))
        agreed = ends.pop()
        out = self._path(agreed)
        self.data, self.last = self.data[agreed:], self.last[agreed:]
        return out

    def finish(self, data: bytes = b"") -> list[int]:
        self._extend(data)
        out = self._path(len(self.data))
        self.data, self.last = b"", [None]
        return out


class Encoder:
    """``feed`` slices of a text, then ``finish``: both return the ids that are certain by then."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.rest = ""
        self.run = None  # how the long piece goes on that is being encoded
        self.piece = Piece(vocabulary)
        added = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pending = ""

    def feed(self, text: str) -> list[int]:
        if self.added is None:
            return self._inner(text, False)
        text, out, at = self.pending + text, [], 0
        for found in self.added.finditer(text):
            out += self._inner(text[at : found.start()], True)
            out.append(self.v.added[found.group()])
            at = found.end()
        held = max((n for t in self.v.added for n in range(1, len(t)) if text.endswith(t[:n], at)), default=0)
        cut = len(text) - held
        self.pending = text[cut:]
        return out + self._inner(text[at:cut], False)

    def finish(self) -> list[int]:
        text, self.pending = self.pending, ""
        return self._inner(text, True)

    def _known(self, piece: str) -> tuple[int, ...]:
        found = self.v.pieces.get(piece) or self.v.recalled(piece)
        if found is None:
            found = tuple(Piece(self.v).finish(piece.encode("utf-8", "surrogatepass")))
            if len(piece) <= 64:
                self.v.remember(piece, found)
        return found

    def _inner(self, text: str, last: bool) -> list[int]:
        out: list[int] = []
        self.rest += text
        if self.run is not None:
            out += self._go_on(last)
            if self.run is not None:
                return out
        pattern = _LATIN_PATTERN if _LATIN_TEXT.fullmatch(self.rest) else PATTERN
        pieces = pattern.findall(self.rest)
        if last:
            self.rest = ""
        else:
            kept = len(self.rest)
            sure = kept - _UNSURE
            while pieces and (kept > sure or kept == len(self.rest)):
                kept -= len(pieces.pop())
            self.rest = self.rest[kept:]
        known = self.v.pieces
        out += chain.from_iterable([known.get(p) or self._known(p) for p in pieces])
        if not last and len(self.rest) > LONG_PIECE:
            self.run = next(r for r in _RUNS if r.match(self.rest[1:2]))
            out += self._go_on(False)
        return out

    def _go_on(self, last: bool) -> list[int]:
        """Encode what the buffer holds of a long piece; ends it when something else follows."""
        found = self.run.match(self.rest, 1 if self.rest[:1] == " " and not self.piece.data and self.piece.last == [None] else 0)
        end = found.end() if found else 0
        over = last or end < len(self.rest)
        if self.run is _SPACES and not (last and end == len(self.rest)):
            end = max(0, end - 1)  # the last blank before something else belongs to what follows
        part = self.rest[:end].encode("utf-8", "surrogatepass")
        self.rest = self.rest[end:]
        if not over:
            return self.piece.push(part)
        self.run = None
        return self.piece.finish(part)


class Decoder:
    """Ids to text, step by step: bytes of an unfinished character wait for the next ids.

    The state is the at most three bytes of a character begun. Bytes that can't become a
    character turn into U+FFFD, one for each longest part that could have begun one.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.table = vocabulary.bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.state.decode(b"".join(map(self.table.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", True)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(text: str) -> Vocabulary:
    """The vocabulary of a file's content, read once per worker."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = Vocabulary(text)
    return _loaded[key]


def encode(v: Vocabulary, text: str | None):
    """Yields the ids of a text in lists, slice by slice; null is as empty."""
    encoder = Encoder(v)
    for at in range(0, len(text or ""), SLICE_CHARS):
        yield encoder.feed(text[at : at + SLICE_CHARS])
    yield encoder.finish()


def public_vocabulary(path: str | None = None) -> str:
    """Content of a vocabulary file on the driver, by default that of the 50k byte BPE (1.6 MB)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def digest(v: Vocabulary, text: str | None) -> tuple[int, str, str]:
    """Number of ids, hash of the ids and hash of the text decoded from them, in constant memory."""
    n, ids_hash, text_hash, decoder = 0, hashlib.sha256(), hashlib.sha256(), Decoder(v)
    for ids in encode(v, text):
        if ids:
            ids_hash.update(("," * (n > 0) + ",".join(map(v.texts.__getitem__, ids))).encode())
            n += len(ids)
            text_hash.update(decoder.feed(ids).encode())
    text_hash.update(decoder.finish().encode())
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


def bpe_digests(docs: DataFrame, content: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text of ``docs``.

    One pass without shuffle. Null and empty texts have no tokens and decode to the empty
    text; repeated rows give repeated rows; null ids stay; other columns don't matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(public_vocabulary() if content is None else content)

    def digests(batch):
        v = vocabulary(shared.value)
        rows = [digest(v, t) for t in batch.column(1).to_pylist()]
        names = ("n_tokens", "ids_sha256", "decoded_sha256")
        return {"doc_id": batch.column(0), **dict(zip(names, zip(*rows)))} if rows else None

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_rows(docs.select(F.col("doc_id").cast("long"), "text"), digests, schema)


def bpe_encode(docs: DataFrame, content: str | None = None) -> DataFrame:
    """doc_id and ``tokens``, the ids of every text (null and empty: none); rows as in ``bpe_digests``."""
    shared = docs.sparkSession.sparkContext.broadcast(public_vocabulary() if content is None else content)

    def encoded(batch):
        v = vocabulary(shared.value)
        tokens = [list(chain.from_iterable(encode(v, t))) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "tokens": tokens}

    return arrow_rows(docs.select(F.col("doc_id").cast("long"), "text"), encoded, "doc_id long, tokens array<int>")


def bpe_round_trip(docs: DataFrame, content: str | None = None) -> DataFrame:
    """As ``bpe_encode``, with the ``text`` that the decoder gives for the tokens as they come (null and empty: empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(public_vocabulary() if content is None else content)

    def there_and_back(batch):
        v = vocabulary(shared.value)
        tokens, texts = [], []
        for text in batch.column(1).to_pylist():
            decoder, ids, parts = Decoder(v), [], []
            for some in encode(v, text):
                ids.extend(some)
                parts.append(decoder.feed(some))
            tokens.append(ids)
            texts.append("".join(parts) + decoder.finish())
        return {"doc_id": batch.column(0), "tokens": tokens, "text": texts}

    return arrow_rows(docs.select(F.col("doc_id").cast("long"), "text"), there_and_back, "doc_id long, tokens array<int>, text string")


def bpe_decode(encoded: DataFrame, content: str | None = None) -> DataFrame:
    """doc_id and ``text`` of rows (doc_id, tokens); null tokens give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(public_vocabulary() if content is None else content)

    def decoded(batch):
        v = vocabulary(shared.value)
        texts = []
        for ids in batch.column(1).to_pylist():
            decoder = Decoder(v)
            texts.append(None if ids is None else decoder.feed(ids) + decoder.finish())
        return {"doc_id": batch.column(0), "text": texts}

    return arrow_rows(encoded.select("doc_id", "tokens"), decoded, "doc_id long, text string")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))
