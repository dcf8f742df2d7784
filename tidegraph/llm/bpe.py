"""BPE encoding and decoding (operator 4) with a contiguous array of ranks per word."""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.llm._tables import table

#: Fixed values of the vocabulary's file format: white space, pieces of words, byte alphabet.
SPACE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|[\x1c-\x1f]+")
SEPARATORS = regex.compile(r"[\x1c-\x1f]")
#: Words of up to this many parts are merged in a flat array, longer ones with a heap.
SHORT = 128
#: Entries of each generation of a cache.
CACHE = 1 << 16
NONE = 1 << 60


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class Recent(dict):
    """A bounded cache of two generations: entries used since the last turn survive it."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        found = self.old.pop(key, None) or self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class WordBpe:
    """A vocabulary in a tokenizers JSON file: words with an end mark, lower case, byte-level."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.end = model["end_of_word_suffix"]
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        self.tokens = {i: t for t, i in vocab.items()} | {x["id"]: x["content"] for x in data["added_tokens"]}
        self.special = {x["content"]: x["id"] for x in data["added_tokens"]}
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + self.end] for c in alphabet]
        self.pieces = Recent(self._piece, 2 * CACHE)
        self.chunks = Recent(self._chunk, CACHE)

    def merge(self, parts: list[int]) -> list[int]:
        """The parts of one word, merged by lowest rank, leftmost first."""
        return self._short(parts) if len(parts) <= SHORT else self._long(parts)

    def _short(self, ids: list[int]) -> list[int]:
        get = self.merges.get
        ranks = [get(p, (NONE, 0))[0] for p in zip(ids, ids[1:], strict=False)]
        while ranks and (low := min(ranks)) < NONE:
            i = ranks.index(low)
            ids[i] = get((ids[i], ids[i + 1]))[1]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), (NONE, 0))[0]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), (NONE, 0))[0]
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        get, n = self.merges.get, len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(m[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = get((left, right))[1], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := get((ids[i], ids[k])):
                    heapq.heappush(heap, (m[0], i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (m := get((ids[h], ids[i]))):
                heapq.heappush(heap, (m[0], h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]

    def _piece(self, piece: str) -> tuple[str, str, int]:
        data = piece.encode()
        ids = self.merge([*map(self.inner.__getitem__, data[:-1]), self.last[data[-1]]])
        return " ".join(map(str, ids)), self.decode(ids), len(ids)

    def _chunk(self, chunk: str) -> tuple[str, str, int]:
        """Of a stretch of text without white space."""
        text = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        parts = [text] if text.isalpha() else PIECE.findall(text)
        if len(parts) == 1 and len(text) <= SHORT:
            return self.pieces[text]
        found = [self.pieces[p] if len(p) <= SHORT else self._piece(p) for p in parts]
        return " ".join(f[0] for f in found), " ".join(f[1] for f in found), sum(f[2] for f in found)

    def encode(self, text: str) -> tuple[str, str, int]:
        """Ids joined by a space, decoded text, and how many ids."""
        found = []
        marked = self.splitter is not None and "<|" in text
        for part in self.splitter.split(text) if marked else (text,):
            if marked and part in self.special:
                found.append((str(self.special[part]), part, 1))
                continue
            words = SPACE.split(part) if SEPARATORS.search(part) else part.split()
            chunks = self.chunks
            found += [chunks[w] if len(w) <= SHORT else self._chunk(w) for w in words if w]
        return " ".join([f[0] for f in found]), " ".join([f[1] for f in found]), sum([f[2] for f in found])

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the file, the tokens joined by a space."""
        return " ".join(self.tokens[i] for i in ids)


@lru_cache(maxsize=2)
def loaded(spec: str) -> WordBpe:
    """One encoder for each Python worker, so that its word cache lasts over tasks."""
    return WordBpe(spec)


def _encoder(broadcast):
    def run(batches):
        bpe = loaded(broadcast.value)
        for b in batches:
            rows = [bpe.encode(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([sha256(r[0].encode()).hexdigest() for r in rows], pa.string()),
                    pa.array([sha256(r[1].encode()).hexdigest() for r in rows], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, over the whole text.

    A null text is an empty one: no tokens, digests of the empty string. Repeated rows give
    repeated rows, null ids stay null, other columns are ignored. vocabulary is the path of
    the tokenizer file on the driver; its contents (a few MB, fixed) are broadcast.
    """
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _encoder(spec), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode_ids(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the token ids themselves as array<int>, and the decoded text."""
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        bpe = loaded(spec.value)
        for b in batches:
            rows = [bpe.encode(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array([[int(x) for x in r[0].split()] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1] for r in rows], pa.string()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded string"
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    return encode_digests(table(spark, sf_dir, "documents"))
