"""SentencePiece encoding and decoding of documents.

The encoder gives the ids that merging by score gives, without a queue of
merges. An Aho-Corasick automaton finds all pieces at all positions of a word.
The longest piece is tried first; it may follow the piece before it only if
merging the two from their characters gives the two back. A position from
which no piece can follow is marked in a bitfield and never reached again.

A piece holds no separator but at its start, and pieces of separators alone
come last in merging; so words are encoded one by one, and a bounded cache of
words spares most of the work. Texts are read, encoded and decoded where they
lie, nothing is shuffled; memory follows the longest text.

Defined cases: a null text counts as empty and has no ids; characters that the
model lacks become their UTF-8 bytes' pieces; repeated rows, null ids and
further columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.llm.common import read_table

SPACE = "▁"
_CACHED_WORD = 64  # longer words are not kept in the cache
_CACHE = 1 << 18
_CACHED_WORDS = 1 << 19


class MergeEncoder:
    """Ids as sentencepiece gives them for a merge-type model that leaves its
    input as it is but for the separators (``add_dummy_prefix``)."""

    def __init__(self, model: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        lib = self.library
        ids = [i for i in range(len(lib)) if not (
            lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.id_of = {lib.id_to_piece(i): i for i in ids}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.rank = {p: -lib.get_score(i) for p, i in self.id_of.items() if len(p) > 1 and p.strip(SPACE)}
        if len(set(self.rank.values())) < len(self.rank) or any(SPACE in p[1:] for p in self.rank):
            raise ValueError("pieces with equal scores or inner separators are not supported")
        self._known = {p for p in self.id_of if len(p) == 1}
        # nothing is ever merged across two characters that are neighbours in no piece
        self._neighbours = {pair for p in self.rank for pair in zip(p, p[1:])}
        self._automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            if len(p) == 1 or p in self.rank and self.merge(p) == [p]:
                self._automaton.add_word(p, p)
        self._automaton.make_automaton()
        self._longest = max(map(len, self.id_of))
        self.follows = lru_cache(_CACHE)(lambda a, b: self.merge(a + b) == [a, b])
        self._word = lru_cache(_CACHED_WORDS)(self._encode_word)
        self._part = lru_cache(_CACHE)(self._encode_part)

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best pair, again and again."""
        parts, rank, never = list(text), self.rank.get, float("inf")
        ranks = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < never:
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], never)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], never)
        return parts

    def _encode_part(self, text: str) -> tuple[int, ...]:
        """Ids of a text whose characters may all be merged. The longest pieces one after the
        other are the first path; most texts need no other."""
        path = [piece for _, piece in self._automaton.iter_long(text)]
        if sum(map(len, path)) != len(text) or not all(map(self.follows, path, path[1:])):
            path = self._backtrack(text)
        return tuple(map(self.id_of.__getitem__, path))

    def _backtrack(self, text: str) -> list[str]:
        follows, pieces, reach, longest = self.follows, self._automaton, self._automaton.longest_prefix, self._longest
        n, at, path = len(text), 0, []
        open_at = bytearray(b"\x01") * (n + 1)
        size = reach(text[:longest])  # no piece at this position is longer
        while at < n:
            before = path[-1] if path else None
            while size:
                piece = text[at:at + size]
                if open_at[at + size] and piece in pieces and (before is None or follows(before, piece)):
                    path.append(piece)
                    at += size
                    size = reach(text[at:at + longest])
                    break
                size -= 1
            else:
                open_at[at] = 0
                path.pop()
                at -= len(before)
                size = len(before) - 1
        return path

    def _encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of a word with the separator before it."""
        text = SPACE + word
        near = self._neighbours
        cuts = [i for i, pair in enumerate(zip(text, word), 1) if pair not in near]
        out: list[int] = []
        for begin, end in zip([0, *cuts], [*cuts, len(text)]):
            part = text[begin:end]
            if end - begin == 1 and part not in self._known:
                out += [self.byte_ids[b] for b in part.encode()]
            else:
                out += self._part(part) if end - begin <= _CACHED_WORD else self._encode_part(part)
        return tuple(out)

    def spaces(self, n: int) -> list[int]:
        """Ids of separators alone: their pieces have equal scores, so the
        leftmost pair is merged first."""
        run: list[int] = []
        for _ in range(n):
            run.append(1)
            while len(run) > 1 and SPACE * (run[-2] + run[-1]) in self.id_of:
                run[-2:] = [run[-2] + run[-1]]
        return [self.id_of[SPACE * k] for k in run]

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        words = text.replace(SPACE, " ").split(" ")
        if "" not in words and max(map(len, words)) <= _CACHED_WORD:
            return list(chain.from_iterable(map(self._word, words)))
        spaces = 0
        single = self.id_of[SPACE]
        cached, plain = self._word, self._encode_word
        for word in words:
            if not word:
                spaces += 1
                continue
            ids = cached(word) if len(word) <= _CACHED_WORD else plain(word)
            if spaces:
                alone = ids[0] == single
                out += self.spaces(spaces + alone)
                out += ids[1:] if alone else ids
                spaces = 0
            else:
                out += ids
        if spaces:
            out += self.spaces(spaces)
        return out

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(2)
def encoder(model: str) -> MergeEncoder:
    return MergeEncoder(model)


def _batches(model: str, per_batch: int, ids_type: pa.DataType, keep: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, per_batch):
                part = batch.slice(begin, per_batch)
                ids = [own.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, ids_type), pa.array([own.decode(x) for x in ids], pa.string())],
                    names=["key", "ids", "decoded"])
        if not keep:
            del own
            encoder.cache_clear()
            gc.collect()  # the encoder's caches refer to it
    return encode


def encode_documents(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", keep: bool = True) -> DataFrame:
    """``key, ids, decoded`` for each row of ``docs``. ``model`` is the path of
    the model file, the same on all executors. ``keep``: whether a worker keeps
    the encoder and its cache of words for its next task."""
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    return picked.mapInArrow(_batches(model, 256, pa.list_(pa.int32()), keep), f"key {kind}, ids array<int>, decoded string")


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        F.col("key").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(encode_documents(read_table(spark, sf_dir, "documents"), default_model()))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids and digests of every document that came this far. Other stages
    use the same workers, so they get their memory back."""
    return digest(encode_documents(docs, default_model(), keep=False))
