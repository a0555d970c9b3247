"""Secret scans by a linear-chain conditional random field.

Tokens are runs of letters, digits and ``+ / _ . -``, and runs of other
characters, within a line; a piece is a line, cut after every ``PIECE`` tokens.
Each token is tagged as begin, inside or outside of a secret. Features are the
shape of the token, the shapes of its neighbours and whether they are words
that announce a secret, and three shares measured on the whole document. The
weights are fitted here, by maximum likelihood, on a bounded sample of
documents (``sample_docs``): a first pass finds those with a base match, of
which a thirtieth of the sample is taken; any others fill it. Of a sampled text
longer than ``EXCERPT`` code points one stretch of that length is taken, about
its first match or else by its hash. Viterbi decoding tags every token of every
text; pieces for which tagging all tokens outside is provably best are not
walked through.

The base matches of the sample alone would teach the field the base patterns.
So it is also given weak labels (``weak_lines``): lines of the sample with the
match written in other ways (``FORMS``: other words that announce it, other
separators, the value alone), some with the value drawn anew over wider
alphabets, and lines with innocent words and numbers put in the same places
(``PLAIN``), in which nothing is a secret.

The base patterns are fixed; their matches are always reported, and spans of
the field that overlap none of them are added as kind ``crf``.

Documents are scanned where they are read; nothing but the sample reaches the
driver. Defined cases: a null or empty text has no spans; repeated rows are
scanned one by one, and are in the sample once; a corpus without any base match
gets no further spans; other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.llm.common import Scratch, read_table, text_bytes

# fixed: the base patterns, the least length, and which group it holds for
BASE_PATTERNS = (
    ("assign", re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32),  # a longest run; shorter ones fail
)
KINDS = ("assign", "access", "hex", "crf")
ANNOUNCING = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "key", "auth", "bearer",
              "access", "private", "credential", "credentials")
PIECE = 256
SAMPLE_DOCS = 3000
EXCERPT = 1 << 14
WEAK_MATCHES = 60

ALPHABETS = ("0123456789abcdef", "0123456789abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
             "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-")
FORMS = ("{w}={v}", '"{w}": "{v}"', "{w} is {v}", "{w} => '{v}'", "{w} {v}", "--{w} {v}", "{w} was set to {v} by", "{v}", "({v})", "{x} {v} {y}")
PLAIN = ("the {w} is {x} {y}", "{w}: {x}", "{w} {x}, {y}", "{w} {n}", "{x}-{y}-{x}", "{x}_{y}_{x}", "/{x}/{y}/{x}.{y}", "{x}.{y}.{x}", "{n}",
         "{n}-{n}-{n}", "{x}{n}", "{x}-{n}", "v{n}.{n}.{n}", "{x}.{y}@{x}.{y}", "{x}.{y}.{n}@{x}{n}.{y}.com", "{X}{Y}{X}", "{U}{U}{U}", "{x} = {n}", "{x}: {y}")
BATCH_BYTES = 4 << 20

OUTSIDE, BEGIN, INSIDE = 0, 1, 2


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base matches, by start, then kind as listed."""
    found = []
    for order, (kind, pattern, group, least) in enumerate(BASE_PATTERNS):
        if kind == "assign" and ":" not in text and "=" not in text or kind == "access" and "AKIA" not in text:
            continue
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                found.append((m.start(), order, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


# --- tokens and features -----------------------------------------------------

_KIND = np.full(256, 2, dtype=np.uint8)  # 0 space, 1 token, 2 other
_KIND[[32, *range(9, 14)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.-", *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CLASS = np.zeros(256, dtype=np.uint8)
for _k, _bytes in enumerate((range(48, 58), range(65, 91), range(97, 123), b"+/_-", range(128, 256), b"=:", b"\"'`"), 1):
    _CLASS[list(_bytes)] = _k
_HEX = np.zeros(256, dtype=bool)
_HEX[[*b"0123456789abcdef"]] = True
_VOWEL = np.zeros(256, dtype=bool)
_VOWEL[[*b"aeiouyAEIOUY"]] = True

_LENGTHS = (1, 2, 3, 5, 8, 12, 16, 24, 32)
_SHARES = (0.0, 0.2, 0.5, 0.99)
_CHANGES = (0, 1, 2, 4, 8)
N_SHAPES = len(_LENGTHS) + 2 * (len(_SHARES) + 1) + len(_CHANGES) + 1 + 11
NEIGHBOURS = (0, -1, -2, 1)
N_FILE = 3


def shapes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 0/1 row of shape features for each token of a dictionary."""
    n = len(offsets) - 1
    out = np.zeros((n + 1, N_SHAPES), dtype=np.float32)  # the last row: no token
    if not n:
        return out
    size = np.diff(offsets)
    count = lambda flags: np.add.reduceat(flags, offsets[:-1], dtype=np.int32)
    kind = _CLASS[data]
    digits, upper, lower, symbols, foreign, separators, quotes = (count(kind == k) for k in range(1, 8))
    change = np.zeros(len(data), dtype=bool)
    change[1:] = kind[1:] != kind[:-1]
    change[offsets[:-1]] = False
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data])])
    announcing = pc.is_in(words, pa.array([w.encode() for w in ANNOUNCING], pa.large_binary())).to_numpy(zero_copy_only=False)
    hexes, vowels = count(_HEX[data]), count(_VOWEL[data])
    letters = upper + lower
    columns = []
    for value, steps in ((size, _LENGTHS), (digits / size, _SHARES), (upper / size, _SHARES), (count(change), _CHANGES)):
        bucket = np.searchsorted(steps, value, side="right" if steps is _LENGTHS else "left")
        first = 1 if steps is _LENGTHS else 0
        columns += [bucket == k for k in range(first, len(steps) + 1)]
    columns += [
        (hexes == size) & (size >= 8), letters == size, symbols > 0, foreign > 0, vowels < 0.15 * letters,
        (digits > 0) & (upper > 0) & (lower > 0), announcing, separators > 0, quotes > 0,
        letters + digits + symbols + foreign == 0, np.ones(n, dtype=bool)]
    out[:n] = np.stack(columns, axis=1)
    return out


@dataclass
class Tokens:
    """The tokens of a batch of texts."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray  # in the table of shapes
    shape: np.ndarray
    piece: np.ndarray  # first tokens of the pieces, and the end
    doc: np.ndarray
    doc_begin: np.ndarray  # byte offsets
    file: np.ndarray  # features of the documents


def tokenize(column: pa.Array) -> Tokens:
    data, offsets = text_bytes(column)
    n_docs = len(offsets) - 1
    kind = _KIND[data]
    begins = np.zeros(len(data), dtype=bool)
    if len(data):
        begins[1:] = (kind[1:] != kind[:-1]) & (kind[1:] != 0)
        begins[0] = kind[0] != 0
    start = np.flatnonzero(begins)
    real = kind != 0
    before = np.cumsum(real, dtype=np.int64)
    cut = np.append(before[start] - 1, before[-1] if len(before) else 0).astype(np.int64)
    coded = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(cut), pa.py_buffer(data[real])]).dictionary_encode()
    table = coded.dictionary
    buffers = table.buffers()
    table_offsets = np.frombuffer(buffers[1], np.int64)[:len(table) + 1] if len(table) else np.zeros(1, np.int64)
    table_data = np.frombuffer(buffers[2], np.uint8)[:table_offsets[-1]] if len(table) else np.zeros(0, np.uint8)
    doc = np.searchsorted(offsets, start, side="right") - 1
    line = np.cumsum(data == 10, dtype=np.int64)[start] if len(start) else np.zeros(0, np.int64)
    new_line = np.flatnonzero(np.diff(line, prepend=-1))
    in_line = np.arange(len(start)) - np.repeat(new_line, np.diff(np.append(new_line, len(start))))
    piece = np.append(np.flatnonzero(in_line % PIECE == 0), len(start))
    size = np.maximum(np.diff(offsets) - 1, 1)
    share = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets]) / size
    classes = _CLASS[data]
    file = np.stack([np.minimum(1, 20 * share(classes == 6)), np.minimum(1, 10 * share(classes == 1)),
                     np.log10(size + 9) / 6], axis=1).astype(np.float32) if n_docs else np.zeros((0, N_FILE), np.float32)
    return Tokens(start, start + np.diff(cut), coded.indices.to_numpy().astype(np.int64), shapes(table_data, table_offsets),
                  piece, doc, offsets, file)


def neighbour_rows(tokens: Tokens) -> list[np.ndarray]:
    """For each neighbour, its row in the table of shapes (the last: none)."""
    n, none = len(tokens.row), len(tokens.shape) - 1
    piece_of = np.repeat(np.arange(len(tokens.piece) - 1), np.diff(tokens.piece))
    out = []
    for step in NEIGHBOURS:
        at = np.arange(n) + step
        inside = (at >= 0) & (at < n)
        at = np.clip(at, 0, max(n - 1, 0))
        out.append(np.where(inside & (piece_of[at] == piece_of), tokens.row[at], none) if n else tokens.row)
    return out


# --- the field -----------------------------------------------------------------

@dataclass
class Field:
    """Weights: shapes by neighbour and tag, file features by tag, transitions."""

    shape: np.ndarray  # [neighbour, feature, tag]
    file: np.ndarray  # [feature, tag]
    move: np.ndarray  # [from, to]

    def scores(self, tokens: Tokens) -> np.ndarray:
        out = (tokens.file @ self.file)[tokens.doc]
        for weights, rows in zip(self.shape, neighbour_rows(tokens)):
            out += (tokens.shape @ weights)[rows]
        return out

    def decode(self, tokens: Tokens) -> np.ndarray:
        """The best tags, by Viterbi in each piece."""
        tags = np.zeros(len(tokens.row), dtype=np.int8)
        if not len(tags):
            return tags
        score = self.scores(tokens)
        # A tag other than outside takes part in two moves, each of which gains
        # at most this over staying outside; if it loses more, it is never best.
        gain = 2 * max(0.0, float((self.move - self.move[OUTSIDE, OUTSIDE]).max()))
        maybe = score[:, 1:].max(axis=1) + gain > score[:, OUTSIDE]
        first, last = tokens.piece[:-1], tokens.piece[1:]
        walk = np.logical_or.reduceat(maybe, first)
        first, size = first[walk], (last - first)[walk]
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        if not len(first):
            return tags
        longest = int(size[0])
        best = score[first].astype(np.float64)
        came = np.zeros((longest, len(first), 3), dtype=np.int8)
        for t in range(1, longest):
            on = int(np.searchsorted(-size, -t, side="left"))  # pieces longer than t
            paths = best[:on, :, None] + self.move
            came[t, :on] = paths.argmax(axis=1)
            best[:on] = paths.max(axis=1) + score[first[:on] + t]
        tag = best.argmax(axis=1).astype(np.int8)
        for t in range(longest - 1, -1, -1):
            on = int(np.searchsorted(-size, -t, side="left"))
            tags[first[:on] + t] = tag[:on]
            tag[:on] = came[t, np.arange(on), tag[:on]]
        return tags


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _mark(tags: np.ndarray, tokens: Tokens, a: int, b: int) -> None:
    lo, hi = np.searchsorted(tokens.end, a, side="right"), np.searchsorted(tokens.start, b)
    tags[lo:hi] = INSIDE
    tags[lo:lo + 1] = BEGIN


def labels(tokens: Tokens, texts: list[str]) -> np.ndarray:
    """Tags of the tokens that base matches cover (the value, for ``assign``)."""
    tags = np.zeros(len(tokens.row), dtype=np.int8)
    for i, text in enumerate(texts):
        for kind, pattern, group, least in BASE_PATTERNS:
            for m in pattern.finditer(text):
                if len(m[group]) >= least:
                    begin = int(tokens.doc_begin[i])
                    a, b = (begin + len(text[:x].encode()) for x in m.span(group))
                    _mark(tags, tokens, a, b)
    return tags


def weak_lines(texts: list[str], around: int = 80) -> tuple[list[str], list[int], list[tuple[int, int] | None]]:
    """Lines with weak labels: their texts, the number of the text that each is
    taken from, and where its secret stands (None: it holds none). Made of the
    first ``WEAK_MATCHES`` base matches."""
    rng = random.Random(11)
    out, source, spans = [], [], []
    words = [w for t in texts for w in re.findall(r"[^\W\d_]{3,12}", t[:2000])] or ["word"]
    matches = []
    for i, text in enumerate(texts):
        end = 0
        for a, b, kind in base_spans(text):
            if a >= end:
                value = next(m[g] for k, p, g, _ in BASE_PATTERNS if k == kind for m in [p.match(text, a)])
                matches.append((i, a, b + text[b:b + 1].count('"'), value))
                end = b
        if len(matches) >= WEAK_MATCHES:
            break
    for i, a, b, value in matches[:WEAK_MATCHES]:
        text = texts[i]
        before, after = text[max(0, a - around):a], text[b:b + around]
        for label, form in [(True, f) for f in FORMS] + [(False, f) for f in PLAIN]:
            v = value if rng.random() < 0.3 else "".join(rng.choices(rng.choice(ALPHABETS), k=rng.randrange(16, 49)))
            v = v.strip("+/_.=-") or value
            w = rng.choice(ANNOUNCING)
            x, y = rng.choice(words), rng.choice(words)
            parts = form.split("{v}")
            named = {"w": rng.choice((w, w, w.upper())), "x": x, "y": y, "X": x.capitalize(), "Y": y.capitalize(), "U": x.upper()}
            filled = [re.sub(r"\{n\}", lambda m: str(rng.randrange(10 ** rng.randrange(1, 9))), p).format(**named) for p in parts]
            begin = len(before) + len(filled[0])
            out.append(before + v.join(filled) + after)
            source.append(i)
            spans.append((begin, begin + len(v)) if label else None)
    return out, source, spans


def fit(texts: list[str], steps: int = 90, penalty: float = 1e-3) -> Field | None:
    """Maximum likelihood by Adam on the pieces with a base match, three times
    as many others with digits and as many without, and the lines with weak
    labels. None if no text matches."""
    texts = [t or "" for t in texts]
    more, source, spans = weak_lines(texts)
    n_texts = len(texts)
    tokens = tokenize(pa.array(texts + more, pa.string()))
    tags = labels(tokens, texts + more)
    for k, span in enumerate(spans):
        if span:
            begin = int(tokens.doc_begin[n_texts + k])
            _mark(tags, tokens, *(begin + len(more[k][:x].encode()) for x in span))
        if k % 2:  # as if the line stood in the text that it is taken from
            tokens.file[n_texts + k] = tokens.file[source[k]]
    first, size = tokens.piece[:-1], np.diff(tokens.piece)
    if not tags.any():
        return None
    weak = tokens.doc[first] >= n_texts
    has = np.logical_or.reduceat(tags > 0, first) & ~weak
    digits = (tokens.shape[:, len(_LENGTHS)] == 0)[tokens.row]  # the first share bucket: no digit
    others = np.random.default_rng(7).permutation(np.flatnonzero(~has & ~weak))
    hard = np.logical_or.reduceat(digits, first)[others]
    want = 3 * int(has.sum())
    picked = np.sort(np.concatenate((np.flatnonzero(has | weak), others[hard][:want], others[~hard][:want])))
    picked = picked[np.argsort(-size[picked], kind="stable")]
    first, size = first[picked], size[picked]
    longest = int(size.max())
    on = np.searchsorted(-size, -np.arange(longest), side="left")  # how many pieces are longer than t
    grid = first[:, None] + np.arange(longest)
    mask = np.arange(longest) < size[:, None]
    flat = grid[mask]
    rows = neighbour_rows(tokens)
    x = np.concatenate([tokens.shape[r[flat]] for r in rows] + [tokens.file[tokens.doc[flat]]], axis=1)
    gold = np.eye(3, dtype=np.float64)[tags[flat]]
    both = mask[:, 1:]
    gold_grid = np.zeros((*mask.shape, 3))
    gold_grid[mask] = gold
    gold_moves = np.einsum("pti,ptj,pt->ij", gold_grid[:, :-1], gold_grid[:, 1:], both.astype(float))
    w, move = np.zeros((x.shape[1], 3)), np.zeros((3, 3))
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (w, move)]
    n = len(flat)
    for step in range(1, steps + 1):
        score = np.zeros((*mask.shape, 3))
        score[mask] = x @ w.astype(np.float32)
        ahead = np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            ahead[:on[t], t] = _log_sum(ahead[:on[t], t - 1, :, None] + move, 1) + score[:on[t], t]
        total = _log_sum(ahead[np.arange(len(size)), size - 1], 1)
        behind = np.zeros_like(score)
        expected = np.zeros((3, 3))
        for t in range(longest - 2, -1, -1):
            n_on = on[t + 1]
            nxt = score[:n_on, t + 1] + behind[:n_on, t + 1]
            expected += np.exp(ahead[:n_on, t, :, None] + move + nxt[:, None, :] - total[:n_on, None, None]).sum(axis=0)
            behind[:n_on, t] = _log_sum(move + nxt[:, None, :], 2)
        share = np.exp((ahead + behind)[mask] - np.repeat(total, size)[:, None])
        grads = (x.T @ (share - gold).astype(np.float32) / n + penalty * w / 10, (expected - gold_moves) / n + penalty * move / 10)
        for value, grad, (m, v) in zip((w, move), grads, state):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= 0.15 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    k = len(NEIGHBOURS) * N_SHAPES
    return Field(w[:k].reshape(len(NEIGHBOURS), N_SHAPES, 3).astype(np.float32), w[k:].astype(np.float32), move)


# --- the job --------------------------------------------------------------------

# what every text with a base match holds, for a first look without Python
_MAY_MATCH = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"""


def _matched(excerpt: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = part.column("text").to_pylist()
                first = [next(iter(base_spans(t)), None) for t in texts]
                held = [k for k, span in enumerate(first) if span]
                cut = [texts[k][max(0, first[k][0] - excerpt // 4):][:excerpt] for k in held]
                part = part.take(pa.array(held, pa.int64()))
                yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(cut, pa.string()))
    return run


def _least(rows: DataFrame, most: int) -> list:
    """The ``most`` distinct rows of the least mark; no more are collected."""
    distinct = rows.agg(F.approx_count_distinct("mark")).first()[0]
    share = min(1.0, (1.2 * most + 6 * most ** 0.5 + 20) / max(distinct, 1))
    few = rows if share == 1.0 else rows.where(F.pmod("mark", F.lit(1 << 30)) < int(share * (1 << 30)) + 64)
    return few.groupBy("mark").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text")).orderBy(
        F.pmod("mark", F.lit(1 << 30)), "mark").limit(most).collect()


def sample_texts(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, excerpt: int = EXCERPT) -> list[str]:
    """At most ``sample_docs`` distinct texts, or stretches of ``excerpt`` code
    points of longer ones, by a hash of id and text: a thirtieth of them with a base match, as far as the corpus has any, and the rest
    whatever they hold."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("mark", F.xxhash64("doc_id", "text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    matched = texts.where(F.col("text").rlike(_MAY_MATCH)).mapInArrow(_matched(excerpt), f"doc_id {kind}, text string, mark bigint")
    matched = Scratch(docs.sparkSession, "secret-scan").write(matched.select("mark", "doc_id", "text"), "matched")
    with_match = _least(matched, -(-sample_docs // 30))
    held = {r["mark"] for r in with_match}
    room = F.greatest(F.length("text") - excerpt, F.lit(0)) + 1
    cut = texts.where(F.col("text").isNotNull()).withColumn("text", F.substr("text", (F.pmod("mark", room) + 1).cast("int"), F.lit(excerpt)))
    others = [r for r in _least(cut, sample_docs) if r["mark"] not in held]
    rows = with_match + others[:sample_docs - len(with_match)]
    return [r["text"] for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["text"]))]


def _field_spans(tags: np.ndarray, tokens: Tokens) -> list[tuple[int, int, int]]:
    """(document, start, end), in bytes of the batch, of runs of tags: a run
    begins at a begin tag, or at an inside tag after an outside one."""
    hit = np.flatnonzero(tags)
    if not len(hit):
        return []
    new = np.ones(len(hit), dtype=bool)
    new[1:] = (np.diff(hit) > 1) | (tags[hit[1:]] == BEGIN) | (np.diff(tokens.doc[hit]) > 0)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(hit)) - 1
    return list(zip(tokens.doc[hit[starts]].tolist(), tokens.start[hit[starts]].tolist(), tokens.end[hit[ends]].tolist()))


def scan_batch(column: pa.Array, field: Field | None) -> list[list[tuple[int, int, str]]]:
    """Spans of each text, in code points."""
    texts = ["" if t is None else t for t in column.to_pylist()]
    found = [base_spans(t) for t in texts]
    if field is None:
        return found
    tokens = tokenize(column)
    for i, begin, end in _field_spans(field.decode(tokens), tokens):
        raw = texts[i].encode()
        begin, end = begin - int(tokens.doc_begin[i]), end - int(tokens.doc_begin[i])
        a = len(raw[:begin].decode())
        b = a + len(raw[begin:end].rstrip(b".-").decode())
        if b > a and not any(x < b and a < y for x, y, _ in found[i]):
            found[i].append((a, b, "crf"))
    return [sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])) for spans in found]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id, spans``: array of (start, end, kind) of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                base = int(sizes[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, base + BATCH_BYTES)))
                part = batch.slice(at, stop - at)
                spans = [[{"start": a, "end": b, "kind": k} for a, b, k in s] for s in scan_batch(part.column(1), field)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, _SPANS)], names=["doc_id", "spans"])
                at = stop

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<start:bigint,end:bigint,kind:string>>")


def secret_scan(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    return scan(docs, fit(sample_texts(docs, sample_docs)))


def digest(scanned: DataFrame) -> DataFrame:
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        "doc_id", *map(count, KINDS), F.sha2(written(F.filter("spans", lambda s: s["kind"] != "crf")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(secret_scan(read_table(spark, sf_dir, "documents")))
