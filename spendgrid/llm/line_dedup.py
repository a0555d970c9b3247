"""Line dedup by a segment-partition edit join.

Two lines of ``min_chars`` code points or more are linked if ``edits`` single
edits or fewer turn one into the other. A line is cut into ``edits + 1``
segments of nearly equal length; a line within reach of it must hold one of
them unchanged, near its place. For each length that a partner may have, a
line's substrings at the places that can match a segment are hashed together
with that length and the segment's number (multi-match-aware selection), which
puts lines into inverted lists; members are then checked by the edit distance,
after lengths and counts of code points have ruled out what they can.

The distance is counted for many pairs at once: after a common start and end
are left off, a band of ``2 * edits + 1`` diagonals is kept as bits of one
64-bit word for each pair, and one step takes a code point of each pair.

:func:`dedup_lines` drops a linked or equal line if an earlier one exists in
the order of (doc_id, line). ``most`` is the share of its code points that a
document may lose; one that would lose more keeps all. The query and the stage
set no such bound (1.0): each line stays at its first place only, and a document
of which nothing is left leaves the stage.
Shorter lines are compared for equality, and never dropped.

Defined cases: a null text counts as empty (one empty line); rows of equal id
and text are one document, and get the same result; a null id is an id that
comes first; further columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendgrid.llm.common import _BASE, _BASE_INVERSE, _powers, Scratch, filtered_scans, mix, read_table, text_of
from spendgrid.llm.lists import classes, dealt_by_group, distinct_lists, pairs_within, shared_entries, whole_groups

EDITS = 2
MIN_CHARS = 20
BATCH_BYTES = 12 << 20
_CHUNK = 1 << 20
_POINT_VALUES = mix(np.arange(0x110000, dtype=np.uint64) + np.uint64(1 << 40))
_POWERS, _INVERSE = _powers(_BASE, _CHUNK + 1), _powers(_BASE_INVERSE, _CHUNK + 1)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, and where each text begins (one more for the end)."""
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), starts


# --- edit distance --------------------------------------------------------------

def within_edits(left: list[str], right: list[str], edits: int) -> np.ndarray:
    """Which pairs are within ``edits`` (at most 30) edits."""
    out = np.zeros(len(left), dtype=bool)
    size = np.array([max(len(a), len(b)) for a, b in zip(left, right)], dtype=np.int64)
    order = np.argsort(size, kind="stable")
    order = order[[abs(len(left[k]) - len(right[k])) <= edits for k in order]]
    at = 0
    while at < len(order):
        widths = size[order[at:]]
        stop = at + max(1, int(np.searchsorted(widths * np.arange(1, len(widths) + 1), 2 << 20)))
        part = order[at:stop]
        out[part] = _band([left[k] for k in part], [right[k] for k in part], edits)
        at = stop
    return out


def _grid(texts: list[str], width: int, fill: int) -> tuple[np.ndarray, np.ndarray]:
    points, starts = code_points(texts)
    size = np.diff(starts)
    grid = np.full((len(texts), width), fill, dtype=np.uint32)
    grid[np.arange(width) < size[:, None]] = points
    return grid, size


def _band(left: list[str], right: list[str], edits: int) -> np.ndarray:
    width = max(1, *(max(len(a), len(b)) for a, b in zip(left, right)))
    a, m = _grid(left, width, 0x110001)
    b, n = _grid(right, width, 0x110002)
    # leave off the common start, then the common end of what is left
    differ = a != b
    head = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    head = np.minimum(head, np.minimum(m, n))
    tail = np.zeros(len(a), dtype=np.int64)
    going = np.arange(len(a))
    while len(going):
        i, j = m[going] - 1 - tail[going], n[going] - 1 - tail[going]
        ok = (i >= head[going]) & (j >= head[going])
        going, i, j = going[ok], i[ok], j[ok]
        same = a[going, i] == b[going, j]
        going = going[same]
        tail[going] += 1
    lead = edits + 1  # equal points put before both, so that a band fits
    m, n = m - head - tail + lead, n - head - tail + lead
    at = lambda grid, first, size, i: np.where(
        i <= lead, 0x110003 + i, np.where(i <= size, grid[np.arange(len(grid)), np.clip(first + i - lead - 1, 0, width - 1)], 0x110001)).astype(np.uint32)
    top = np.uint64(63)
    ahead = np.full(len(a), ((1 << (edits + 1)) - 1) << (63 - edits), dtype=np.uint64)  # vertical +1
    back = np.zeros(len(a), dtype=np.uint64)  # vertical -1
    dist = np.full(len(a), edits, dtype=np.int64)
    for j in range(1, int(n.max()) + 1):
        point = at(b, head, n, j)
        match = np.zeros(len(a), dtype=np.uint64)
        for d in range(-edits, edits + 1):
            if j + d >= 1:
                match |= ((at(a, head, m, j + d) == point) & (j + d <= m)).astype(np.uint64) << np.uint64(63 - edits + d)
        same = (((match & ahead) + ahead) ^ ahead) | match | back
        up = back | ~(same | ahead)
        down = same & ahead
        live = j <= n
        slant = live & (j <= m - edits)
        dist[slant] += (same[slant] >> top == 0)
        flat = np.flatnonzero(live & ~slant)
        bit = (63 - (j + edits - m[flat])).astype(np.uint64)
        dist[flat] += ((up[flat] >> bit) & np.uint64(1)).astype(np.int64)
        dist[flat] -= ((down[flat] >> bit) & np.uint64(1)).astype(np.int64)
        shifted = same >> np.uint64(1)
        ahead, back = down | ~(shifted | up), shifted & up
    return dist <= edits


# --- hashes of segments ------------------------------------------------------------

def line_node(line: str) -> int:
    """Spark's ``xxhash64`` of the line."""
    h = xxhash.xxh64_intdigest(line.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def segment_keys(lines: list[str], edits: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the line) of all substrings to look under. ``least`` is
    the length of the shortest line that takes part."""
    keys, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    at = 0
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    ends = np.cumsum(sizes)
    while at < len(lines):
        base = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + _CHUNK, side="right")))
        points, starts = code_points(lines[at:stop])
        powers, inverse = (_POWERS, _INVERSE) if len(points) <= _CHUNK else (
            _powers(_BASE, len(points) + 1), _powers(_BASE_INVERSE, len(points) + 1))
        running = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum(_POINT_VALUES[points] * powers[:len(points)], out=running[1:])
        size, first = sizes[at:stop], starts[:-1]
        for shorter in range(edits + 1):
            length = size - shorter  # of the line whose segments are looked for
            short, longer = length // (edits + 1), length % (edits + 1)
            for i in range(edits + 1):
                extra = np.maximum(0, i - (edits + 1 - longer))
                place, span = i * short + extra, short + (i >= edits + 1 - longer)
                lo = np.maximum(np.maximum(0, place - i), place + shorter - (edits - i))
                hi = np.minimum(np.minimum(size - span, place + i), place + shorter + (edits - i))
                for step in range(2 * edits + 1):
                    ok = np.flatnonzero((lo + step <= hi) & (length >= least))
                    if not len(ok):
                        continue
                    begin = first[ok] + lo[ok] + step
                    found = (running[begin + span[ok]] - running[begin]) * inverse[begin]
                    keys.append(mix(found + mix(length[ok].astype(np.uint64) * np.uint64(64) + np.uint64(i))))
                    of.append(ok + at)
        at = stop
    return np.concatenate(keys), np.concatenate(of)


def _entries(batches: Iterator[pa.RecordBatch], edits: int, min_chars: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, node) of about ``BATCH_BYTES`` of text at a time."""
    seen: dict[str, None] = {}
    held = 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        lines = list(seen)
        nodes = np.array([line_node(x) for x in lines], dtype=np.int64)
        keys, of = segment_keys(lines, edits, min_chars)
        return keys, nodes[of] if len(of) else np.zeros(0, np.int64)

    for batch in batches:
        for text in batch.column(0).to_pylist():
            for line in (text or "").split("\n"):
                if len(line) >= min_chars and line not in seen:
                    seen[line] = None
                    held += len(line)
            if held >= BATCH_BYTES:
                yield flush()
                seen, held = {}, 0
    if seen:
        yield flush()


def _check(edits: int):
    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                keep = within_edits(part.column("line_a").to_pylist(), part.column("line_b").to_pylist(), edits)
                yield part.select(["a", "b"]).filter(pa.array(keep))
    return run


MARKS = 32


def _mark(batches):
    """Length and counts of 32 classes of code points (modulo 256)."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 4096):
            part = batch.slice(begin, 4096)
            points, starts = code_points(part.column("body").to_pylist())
            size = np.diff(starts)
            of = np.repeat(np.arange(len(size)) * MARKS, size) + (_POINT_VALUES[points] >> np.uint64(59)).astype(np.int64)
            counts = np.bincount(of, minlength=MARKS * len(size)).astype(np.uint8).reshape(-1, MARKS)
            yield pa.RecordBatch.from_arrays([
                part.column("node"), pa.array(size), pa.array([c.tobytes() for c in counts], pa.binary())], names=["node", "chars", "mark"])


def _may_be_within(a_chars, b_chars, a_mark, b_mark, edits: int) -> np.ndarray:
    """An edit changes the length by one at most, and two counts by one."""
    ok = np.abs(a_chars - b_chars) <= edits
    at = np.flatnonzero(ok)
    change = np.abs(np.subtract(a_mark[at], b_mark[at]).view(np.int8).astype(np.int16)).sum(axis=1)  # modulo 256, signed
    ok[at] = change <= 2 * edits
    return ok


def _marks_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, MARKS)


def _likely(edits: int):
    def run(batches):
        for batch in batches:
            keep = _may_be_within(batch.column("chars_a").to_numpy(), batch.column("chars_b").to_numpy(),
                                  _marks_of(batch.column("mark_a")), _marks_of(batch.column("mark_b")), edits)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _likely_in_blocks(edits: int):
    """Pairs of different components of a list that may be within reach."""
    def run(batches):
        for table, cuts in whole_groups(batches, ["value", "i", "j"]):
            node, comp, block, i, j, chars = (table.column(c).to_numpy() for c in ("node", "comp", "block", "i", "j", "chars"))
            marks = _marks_of(table.column("mark"))
            for x, y in pairs_within(cuts):
                ok = (comp[x] != comp[y]) & ((block[x] != block[y]) | (i[x] == j[x])) & (np.abs(chars[x] - chars[y]) <= edits)
                x, y = x[ok], y[ok]
                ok = _may_be_within(chars[x], chars[y], marks[x], marks[y], edits)
                a, b = node[x[ok]], node[y[ok]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
    return run


# --- the job --------------------------------------------------------------------------

def line_classes(docs: DataFrame, scratch: Scratch, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_hash, line, chars, class_doc, class_line``: for each line
    the first place of its class."""
    texts = docs.select("doc_id", text_of().alias("text"))
    at = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line", "s"))
    lines = scratch.write(at.select("doc_id", "text_hash", "line", F.xxhash64("s").alias("node"), F.length("s").alias("chars")), "lines")
    long = lines.where(F.col("chars") >= min_chars)
    n_entries = long.count() * (edits + 1) * (edits + 2)
    members = distinct_lists(shared_entries(
        texts.select("text"), lambda batches: _entries(batches, edits, min_chars), n_entries, scratch), scratch)

    # the texts of listed lines, from the first place of each
    listed = members.select("node").distinct()
    place = long.join(listed, "node").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash", "line")).alias("p"))
    places = scratch.write(place.select("node", F.col("p.doc_id").alias("at_doc"), F.col("p.text_hash").alias("at_hash"), F.col("p.line").alias("at_line")), "places")
    wanted = scratch.write(places.groupBy("at_doc", "at_hash").agg(F.collect_list(F.struct("node", "at_line")).alias("asked")).withColumn("n", F.size("asked")), "asked")
    asked = wanted.where("n > 0")
    read = texts.join(
        asked, texts["doc_id"].eqNullSafe(asked["at_doc"]) & (F.xxhash64(texts["text"]) == asked["at_hash"])).select(F.split("text", "\n").alias("s"), F.explode("asked").alias("q"))
    with filtered_scans(docs.sparkSession):
        body = scratch.write(read.select(F.col("q.node").alias("node"), F.get("s", F.col("q.at_line")).alias("body")).where(
            F.xxhash64("body") == F.col("node")).dropDuplicates(["node"]), "bodies")
    marks = scratch.write(body.mapInArrow(_mark, "node bigint, chars bigint, mark binary"), "marks")

    def check(pairs: DataFrame, name: str) -> DataFrame:
        mark = lambda s: marks.select(F.col("node").alias(s), F.col("chars").alias(f"chars_{s}"), F.col("mark").alias(f"mark_{s}"))
        side = lambda s: body.select(F.col("node").alias(s), F.col("body").alias(f"line_{s}"))
        likely = scratch.write(pairs.join(mark("a"), "a").join(mark("b"), "b").mapInArrow(_likely(edits), "a bigint, b bigint"), "likely")
        return scratch.write(likely.join(side("a"), "a").join(side("b"), "b").select("a", "b", "line_a", "line_b").mapInArrow(
            _check(edits), "a bigint, b bigint"), name)

    def compare(dealt: DataFrame) -> DataFrame:
        maybe = dealt_by_group(dealt.join(marks, "node")).mapInArrow(_likely_in_blocks(edits), "a bigint, b bigint")
        return check(scratch.write(maybe.distinct(), "in-blocks"), "block-checked")

    roots = classes(members, scratch, check, compare, block=4096)  # a row is a few bytes
    scratch.drop(members, places, wanted, body, marks)  # the roots are written
    named = lines.join(roots, "node", "left").select(
        "doc_id", "text_hash", "line", "chars", F.coalesce("root", "node").alias("class"))
    firsts = named.groupBy("class").agg(F.min(F.struct("doc_id", "text_hash", "line")).alias("at"))
    return named.join(firsts, "class").select(
        "doc_id", "text_hash", "line", "chars", F.col("at.doc_id").alias("class_doc"), F.col("at.line").alias("class_line"),
        (F.struct("doc_id", "text_hash", "line") != F.col("at")).alias("repeated"))


def document_lines(docs: DataFrame, scratch: Scratch, edits: int = EDITS, min_chars: int = MIN_CHARS, most: float = 1.0) -> DataFrame:
    """For each (doc_id, text_hash): ``n_lines, n_repeated, dropped`` (line
    numbers) and ``classes`` (first place of each line's class, in order)."""
    of_line = line_classes(docs, scratch, edits, min_chars)
    rows = of_line.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct(
        "line", "chars", "repeated", F.struct(F.col("class_doc").alias("doc_id"), F.col("class_line").alias("line")).alias("class")))).alias("l"))
    repeated = F.filter("l", lambda x: x["repeated"] & (x["chars"] >= min_chars))
    chars = lambda array: F.aggregate(array, F.lit(0).cast("long"), lambda s, x: s + x["chars"])
    return rows.select(
        "doc_id", "text_hash", F.size("l").cast("long").alias("n_lines"),
        F.size(F.filter("l", lambda x: x["repeated"])).cast("long").alias("n_repeated"),
        F.when(chars(repeated) <= most * chars(F.col("l")), F.transform(repeated, lambda x: x["line"])).otherwise(
            F.array().cast("array<int>")).alias("dropped"),
        F.transform("l", lambda x: x["class"]).alias("classes"))


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, most: float = 0.5, emptied: bool = True) -> DataFrame:
    """The rows of ``docs``, all columns, with dropped lines left out of
    ``text``. A text of which nothing is dropped stays as it is, null too. Rows
    whose text has lost all but white space stay if ``emptied``."""
    scratch = Scratch(docs.sparkSession, "line-dedup")
    found = document_lines(docs, scratch, edits, min_chars, most).where(F.size("dropped") > 0)
    drops = scratch.write(found.select(F.col("doc_id").alias("drop_doc"), F.col("text_hash").alias("drop_hash"), "dropped"), "drops")
    keyed = docs.select(F.struct("*").alias("row"), text_of().alias("text_"))
    joined = keyed.join(drops, F.col("row.doc_id").eqNullSafe(F.col("drop_doc")) & (F.xxhash64("text_") == F.col("drop_hash")), "left")
    left = F.array_join(F.filter(F.split("text_", "\n"), lambda s, i: ~F.array_contains("dropped", i)), "\n")
    if not emptied:
        joined = joined.where(F.col("dropped").isNull() | left.rlike(r"[^\x20\x09-\x0D]"))
    return joined.select(F.col("row").withField("text", F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(left)).alias("row")).select("row.*")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return document_lines(docs, Scratch(spark, "line-dedup")).select(
        "doc_id", "n_lines", "n_repeated", F.size("dropped").cast("long").alias("n_dropped"), "dropped", "classes")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that stood before, as far as any are left."""
    return dedup_lines(docs, most=1.0, emptied=False)
