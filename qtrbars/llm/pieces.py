"""Operator 10: SentencePiece encoding and decoding for merge-type models.

The text becomes a row of symbols (code points, spaces as U+2581, one put in
front). Every adjacent pair whose union is in the vocabulary is put on an
agenda ordered by score, then by place; the best pair is merged, its new
neighbours join the agenda, and entries whose symbols have changed since are
skipped. Symbols left outside the vocabulary are written as bytes.

No merge reaches over two characters that stand side by side in no piece, as
a letter and the space after it, so a text's agenda falls apart into those of
its words, and a word's into those of its parts; each distinct one is solved
once (a bounded cache for each Python worker). What falls apart is read from
the vocabulary; where nothing does, the whole text is one agenda. With
``verify`` every Arrow batch is held against the sentencepiece library, ids and
decoded text, and a difference raises: ``verify=1`` compares every text,
``verify=n`` each n-th text of a batch and always its first.

Defined results: null and empty texts have no ids and decode to an empty
text; repeated rows repeat their result; an empty input gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import slices

SPACE = "▁"
CACHE_WORDS = 800_000


class MergeModel:
    """A merge-type model, solved by a score-ordered agenda."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        lib, n = self.library, self.library.vocab_size()
        _check_supported(model)
        self.ids, self.bytes, self.text = {}, [0] * 256, [""] * n
        self.raw: dict[int, int] = {}
        for i in range(n):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.raw[i] = value
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[piece] = i
                self.text[i] = piece.replace(SPACE, " ")
        joined = [p for p in self.ids if len(p) > 1]
        # rank: equal scores share one, then the leftmost pair goes first
        ranks = {v: k for k, v in enumerate(sorted({lib.get_score(self.ids[p]) for p in joined}, reverse=True))}
        self.merges = {self.ids[p[:k]] * n + self.ids[p[k:]]: (ranks[lib.get_score(self.ids[p])], self.ids[p])
                       for p in joined for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids}
        self.beside = {p[k:k + 2].replace(SPACE, " ") for p in joined for k in range(len(p) - 1)}
        # spaces only lead pieces: words end before them; likewise a character of no longer piece is a word
        self.by_word = not any(x[1] == " " and x[0] != " " for x in self.beside)
        alone = "" if any("\n" in x for x in self.beside) else "\n"
        self.split = re.compile((alone and alone + "|") + f" *[^ {alone}]+| +")
        self.cache: dict[str, str] = {}
        self.odd: dict[str, str] = {}

    def solve(self, word: str) -> list[int]:
        """Ids of one word by the agenda.

        A symbol is a piece's id, or minus one less a code point outside the
        vocabulary, which no merge takes up. An entry of the agenda is
        rank * n + place; it holds while the pair now at that place has that rank.
        """
        merges, known = self.merges, self.ids
        n, width = len(word), len(self.text)
        symbols = [known.get(c, ~ord(c)) for c in word.replace(" ", SPACE)]
        right = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            found = merges.get(symbols[i] * width + symbols[i + 1])
            if found is not None:
                agenda.append(found[0] * n + i)
        heapq.heapify(agenda)
        while agenda:
            rank, i = divmod(heapq.heappop(agenda), n)
            j = right[i]
            if j >= n:
                continue
            found = merges.get(symbols[i] * width + symbols[j])
            if found is None or found[0] != rank:
                continue
            symbols[i] = one = found[1]
            right[i] = after = right[j]
            right[j] = n  # merged away: no pair starts there any more
            if after < n:
                left[after] = i
                found = merges.get(one * width + symbols[after])
                if found is not None:
                    heapq.heappush(agenda, found[0] * n + i)
            before = left[i]
            if before >= 0:
                found = merges.get(symbols[before] * width + one)
                if found is not None:
                    heapq.heappush(agenda, found[0] * n + before)
        out: list[int] = []
        i = 0
        while i < n:
            s = symbols[i]
            if s >= 0:
                out.append(s)
            else:
                out.extend(self.bytes[b] for b in chr(~s).encode())
            i = right[i]
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids; runs of bytes are read as UTF-8, the space put in front is dropped."""
        if self.raw.keys().isdisjoint(ids):
            return "".join([self.text[i] for i in ids]).removeprefix(" ")
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.raw:
                run.append(self.raw[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.text[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out).removeprefix(" ")

    def word(self, word: str) -> str:
        """Ids of one word as decimals joined by commas, kept; their text is kept where it isn't the word."""
        beside = self.beside
        cuts = [0, *(k for k in range(1, len(word)) if word[k - 1:k + 1] not in beside), len(word)]
        found = []
        for a, b in zip(cuts, cuts[1:]):
            part = word[a:b]
            ids = self.cache.get(part) if len(cuts) > 2 else None
            if ids is None:
                solved = self.solve(part)
                ids = ",".join(map(str, solved))
                self.keep(part, ids, solved)
            found.append(ids)
        if len(cuts) > 2:
            self.keep(word, ",".join(found), None)
        return ",".join(found)

    def keep(self, word: str, ids: str, solved: list[int] | None) -> None:
        text = self.decode([self.dummy, *(solved or map(int, ids.split(",")))])
        if text != word:
            self.odd[word] = text
        if len(word) <= 64:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = ids

    @property
    def dummy(self) -> int:
        return self.ids[SPACE]

    def words(self, text: str) -> tuple[list[str], str]:
        """(words, ids joined by commas) of a text that isn't empty."""
        text = " " + text.replace(SPACE, " ")
        parts = self.split.findall(text) if self.by_word else [text]
        get, solve = self.cache.get, self.word
        return parts, ",".join([get(w) or solve(w) for w in parts])

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.words(text)[1].split(","))) if text else []

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text)."""
        parts, ids = self.words(text) if text else ([], "")
        if self.odd:
            parts = [self.odd.get(w, w) for w in parts]
        if len(self.odd) >= CACHE_WORDS:  # together: a word kept without its text would pass for the text
            self.odd.clear()
            self.cache.clear()
        return _digests(ids, "".join(parts).removeprefix(" "))


def _digests(ids: str, decoded: str) -> tuple[int, str, str]:
    return (ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if key & 7 == 2 else 8 if key & 7 == 1 else 4
        yield key >> 3, message[at:at + size]
        at += size


def _check_supported(model: bytes) -> None:
    """Only what this operator implements; anything else raises."""
    top = list(_fields(model))
    trainer = dict(_fields(next((v for f, v in top if f == 2), b"")))
    normalizer = dict(_fields(next((v for f, v in top if f == 3), b"")))
    if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
        raise ValueError("a merge-type model with byte fallback is needed")
    if normalizer.get(2, b"") or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
        raise ValueError("a model with the identity normalizer is needed")
    if any(dict(_fields(v)).get(3, 1) == 4 for f, v in top if f == 1):
        raise ValueError("user-defined pieces aren't supported")


_MODELS: dict[str, MergeModel] = {}


def load(model: bytes) -> MergeModel:
    """The model, built once a Python worker."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _MODELS:
        _MODELS[key] = MergeModel(model)
    return _MODELS[key]


def _checked(model: MergeModel, texts: list[str]) -> None:
    """Raises where the library's ids, or the text it decodes them to, aren't this model's."""
    library = model.library
    encoded = library.encode(texts, num_threads=1)
    for text, ids, decoded in zip(texts, encoded, library.decode(encoded, num_threads=1), strict=True):
        if model.digest(text) != _digests(",".join(map(str, ids)), decoded):
            raise ValueError(f"the ids of a text, or what they decode to, differ from the library's: {text[:80]!r}")


def _model_bytes(model_path: str) -> bytes:
    with open(model_path, "rb") as f:
        return f.read()


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           verify: int = 0) -> DataFrame:
    """(id, ids): the ids of every whole text."""
    kind = df.schema[id_col].dataType.simpleString()
    return _apply(df, model_path, id_col, text_col, verify,
                  lambda m, t: (m.encode(t),), f"{id_col} {kind}, ids array<int>", [pa.list_(pa.int32())])


def encode_digests(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                   verify: int = 0) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text."""
    kind = df.schema[id_col].dataType.simpleString()
    return _apply(df, model_path, id_col, text_col, verify, lambda m, t: m.digest(t),
                  f"{id_col} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                  [pa.int64(), pa.string(), pa.string()])


def decode(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of rows of (id, ids)."""
    data = _model_bytes(model_path)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(data)
        for batch in batches:
            texts = [model.decode(x or []) for x in batch[1].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(texts, pa.string())], names=[id_col, "text"])

    return df.select(id_col, F.col(ids_col).alias("ids")).mapInArrow(run, f"{id_col} {kind}, text string")


def _apply(df: DataFrame, model_path: str, id_col: str, text_col: str, verify: int, each, schema: str,
           types: list[pa.DataType]) -> DataFrame:
    data = _model_bytes(model_path)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(data)
        for batch in batches:
            for a, b in slices(batch[1]):
                part = batch.slice(a, b - a)
                texts = [t or "" for t in part[1].to_pylist()]
                if verify:
                    _checked(model, texts[::verify])
                found = [each(model, t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part[0], *(pa.array([x[k] for x in found], t) for k, t in enumerate(types))], names=names)

    return df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)
