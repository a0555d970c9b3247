"""Personal data by weak supervision.

1. Candidates: every base match, and wider forms of the same things: anything
   around an ``@`` or a spelled-out one, chains of 7 to 19 digits, and
   capitalised words after a title or an introduction.
2. Labelers (``LABELERS``) each look at one thing, a pattern, a gazetteer or
   the words around, and vote for or against, or abstain.
3. The votes of all candidates of the corpus are counted by pattern of votes;
   there are at most ``2 ** len(LABELERS)`` patterns of each of the three forms.
   Expectation-maximisation over these counts estimates how often each labeler
   fires on personal and on other spans, and from it the probability that the
   spans of a pattern are personal.
4. A logistic model of the span's shape and neighbouring words, which sees no
   votes, is trained on those probabilities. Its rows are distinct candidates
   with their counts, at most ``sample_spans``, dealt evenly to the patterns
   and weighted to stand for all candidates.
5. Candidates that the model holds for personal and that overlap no base match
   are added, as kind ``contact``, ``number`` or ``name``. Base matches are
   always reported.

A text is read once, where it lies; candidates are written as positions, votes
and feature numbers. Every pattern is matched in time proportional to the text:
no part of it can begin again at each character of a long run.

Defined cases: a null or empty text has no spans; equal texts and repeated rows
are reported one by one; a corpus without candidates, or with candidates of one
class only, gets no further spans; null ids are ids like others; other columns
do not matter; an empty table gives no rows. A very long text is one row, read
as a whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendgrid.llm.common import Scratch, read_table

BASE_KINDS = ("email", "ip", "card", "phone")
FORMS = ("contact", "number", "name")
KINDS = BASE_KINDS + FORMS
SAMPLE_SPANS = 20_000

# --- base patterns: as given, written so that no run is read twice --------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CHAIN = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = str.maketrans("", "", " ().-+")


def _before_at(text: str, at: int, least: int, letters: str) -> int:
    """Where the run of ``letters`` that ends at ``at`` begins, not before ``least``."""
    begin = at
    while begin > least:
        head = text[max(least, begin - 64):begin]
        kept = len(head) - len(head.rstrip(letters))
        begin -= kept
        if kept < len(head):
            break
    return begin


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(x * 2 - 9 * (x > 4) for x in map(int, digits[-2::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base matches, by kind as listed, then start."""
    found = []
    end = 0
    for m in _AT_DOMAIN.finditer(text) if "@" in text else ():
        begin = _before_at(text, m.start(), end, _LOCAL)
        if begin < m.start():
            end = m.end()
            found.append(("email", begin, end))
    for m in _IP.finditer(text):
        # a part of more than three digits can still be at most 255
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CHAIN.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].translate(_DIGITS)
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(m[0].translate(_DIGITS)) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


# --- candidates ------------------------------------------------------------------

_CONTACT = "".join(chr(c) for c in range(33, 127) if chr(c) not in "@<>()[]{},;:\"'|")
_AFTER_AT = re.compile(r"@[^\s@<>()\[\]{},;:\"'|]+")
_SPELLED = re.compile(r"(?<![\w.+-])[\w.+-]{1,64}(?:\x20?[(\[]\x20?|\x20)(?i:at)(?:\x20?[)\]]\x20?|\x20)[\w-]{1,63}(?:(?:\x20?[(\[]\x20?|\x20)(?i:dot)(?:\x20?[)\]]\x20?|\x20)|\.)[A-Za-z]{2,24}\b")
_NUMBER = re.compile(r"[0-9]++(?:[\x20().-]{1,2}[0-9]++)*+")
_INTRODUCED = re.compile(
    r"\b(?:(?:Mr|Mrs|Ms|Dr|Prof)\.?|Herrn?|Frau|Monsieur|Madame|Señora?|[Mm]y\x20name\x20is|[Nn]ame:|[Ii]ch\x20heiße|[Jj]e\x20m'appelle|[Mm]e\x20llamo)"
    r"\x20([A-ZÀ-Þ][a-zß-ÿ'-]{1,30}(?:\x20[A-ZÀ-Þ][a-zß-ÿ'-]{1,30}){0,2})")
CONTEXT = 48


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, int]]:
    """(form, start, end): base matches, and wider forms that overlap none."""
    found = [(0 if kind == "email" else 1, a, b) for kind, a, b in base]
    wide = []
    end = 0
    for m in _AFTER_AT.finditer(text) if "@" in text else ():
        begin = _before_at(text, m.start(), end, _CONTACT)
        if begin < m.start():
            end = m.end()
            wide.append((0, begin, begin + len(text[begin:end].rstrip(".!?"))))
    lower = "at" in text or "AT" in text
    wide += [(0, m.start(), m.end()) for m in _SPELLED.finditer(text)] if lower and ("dot" in text or "DOT" in text) else []
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() >= 7:
            count = len(m[0].translate(_DIGITS))
            if 7 <= count <= 19:
                begin = m.start()
                begin -= text[max(0, begin - 1):begin] == "("
                begin -= text[max(0, begin - 1):begin] == "+"
                wide.append((1, begin, m.end()))
    wide += [(2, m.start(1), m.end(1)) for m in _INTRODUCED.finditer(text)]
    # wide ones come by start within a form; each must be clear of base matches
    spans = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in spans]
    reach = np.maximum.accumulate([b for _, b in spans]).tolist() if spans else []
    for form, a, b in wide:
        k = bisect_left(starts, b)
        if not (k and reach[k - 1] > a):
            found.append((form, a, b))
    return found


# --- labelers ----------------------------------------------------------------------

# fixed: gazetteers
TOP_LEVEL = frozenset("com org net edu gov io co info biz de fr es uk us ca eu it nl ch at be pl se no dk fi ie pt br mx jp cn in au".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
                 "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92")
GIVEN_NAMES = frozenset("""james mary john anna maria robert linda michael sarah david laura thomas emma paul julia peter claire
    hans greta klaus ursula jean marie pierre sophie luc camille jose carmen juan lucia carlos elena pablo sofia""".split())
ANNOUNCING = frozenset("""phone tel telephone mobile cell call fax contact mail email e-mail address card visa mastercard iban ssn
    social ip telefon handy anruf kontakt karte téléphone appelez carte teléfono móvil tarjeta whatsapp reach name heiße appelle llamo""".split())
OTHER_NUMBERS = frozenset("""order invoice version isbn issn page build ref reference ticket article item no nr id serial model
    chapter section figure rfc port lot batch sku bestellung rechnung seite commande facture pedido factura""".split())

_NATIONAL = re.compile(r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|0[0-9]{2,4}[\x20/-][0-9]{5,8}")
_SOCIAL = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_DATE = re.compile(r"[0-9]{4}[.-][0-9]{1,2}[.-][0-9]{1,2}|[0-9]{1,2}[.-][0-9]{1,2}[.-][0-9]{4}|(?:1[89]|20)[0-9]{2}\x20?-\x20?(?:1[89]|20)[0-9]{2}")
_GROUPED = re.compile(r"[0-9]{1,3}(?:[\x20.][0-9]{3})+|[0-9]+\.[0-9]+")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")

#: Votes of a labeler: all for personal, or all against; it abstains otherwise.
LABELERS = ("pattern", "top-level domain", "calling code", "card checksum", "given name", "announced",
            "other number announced", "failed checksum", "date or amount", "part of a word")
AGAINST = frozenset(("other number announced", "failed checksum", "date or amount", "part of a word"))


def votes(text: str, form: int, a: int, b: int, is_base: bool, before: list[str]) -> int:
    """Bits of the labelers that fire on the span; ``before``: words before it."""
    span = text[a:b]
    digits = span.translate(_DIGITS) if form == 1 else ""
    near = before[-3:]
    fires = (
        is_base or form == 0 and "@" not in span or form == 1 and bool(_NATIONAL.fullmatch(span) or _SOCIAL.fullmatch(span)),
        form == 0 and span.rpartition(".")[2].lower() in TOP_LEVEL,
        form == 1 and span[0] == "+" and digits.startswith(CALLING_CODES),
        form == 1 and 13 <= len(digits) <= 19 and digits[0] in "3456" and luhn(digits),
        form == 2 and span.split(" ")[0].lower() in GIVEN_NAMES,
        any(w in ANNOUNCING for w in near),
        any(w in OTHER_NUMBERS for w in near),
        form == 1 and len(digits) >= 13 and not luhn(digits),
        form == 1 and bool(_DATE.fullmatch(span) or not is_base and _GROUPED.fullmatch(span)),
        form == 1 and (text[a - 1:a].isalnum() or text[b:b + 1].isalnum() or text[a - 1:a] in ("_", "=", "#", "$") or text[b:b + 1] in ("%", "_")),
    )
    return sum(1 << k for k, fired in enumerate(fires) if fired)


# --- features of the final model -----------------------------------------------------

WORD_BUCKETS = 1024
_LENGTHS = (4, 8, 10, 12, 14, 16, 18, 24)
N_SHAPES = 64
N_FEATURES = N_SHAPES + 3 * WORD_BUCKETS


def features(span: str, form: int, left: str, right: str, before: list[str], after: list[str]) -> list[int]:
    """Numbers of the features that hold: shape, then words around, hashed."""
    groups = re.findall(r"[0-9]+", span[:64])
    shape = [form, 3 + int(np.searchsorted(_LENGTHS, len(span))), 12 + min(len(groups), 6)]
    tests = (span[0] == "+", "(" in span, "-" in span, " " in span, span.count(".") == 1, span.count(".") == 3, span.count(".") > 3,
             "@" in span, "@" in span and "." in span.partition("@")[2], left.isalnum(), right.isalnum(), left in ("", " ", "\n"),
             right in ("", " ", "\n", ".", ","), span.isdigit(), bool(groups) and all(len(g) <= 3 for g in groups),
             bool(groups) and len(groups[-1]) == 4, form == 1 and len(span) >= 16 and span.isdigit())
    shape += [20 + k for k, held in enumerate(tests) if held]
    words = (before[-1] if before else "", before[-2] if len(before) > 1 else "", after[0] if after else "")
    return shape + [N_SHAPES + k * WORD_BUCKETS + crc32(w.encode()) % WORD_BUCKETS for k, w in enumerate(words)]


def scan_text(text: str) -> tuple[list, list]:
    """The base matches and the candidates (form, start, end, is base, votes, features)."""
    base = base_spans(text)
    out = []
    for k, (form, a, b) in enumerate(candidates(text, base)):
        before = [w.lower() for w in _WORD.findall(text[max(0, a - CONTEXT):a])]
        after = [w.lower() for w in _WORD.findall(text[b:b + CONTEXT])[:1]]
        is_base = k < len(base)
        out.append((form, a, b, is_base, votes(text, form, a, b, is_base, before),
                    features(text[a:b], form, text[a - 1:a] if a else "", text[b:b + 1], before, after)))
    return base, out


# --- expectation-maximisation ------------------------------------------------------

def reliabilities(patterns: list[tuple[int, int, int]], rounds: int = 100) -> dict[tuple[int, int], float]:
    """The probability that spans are personal, by (form, votes), from rows
    (form, votes, count). In each form, every labeler fires at one rate on
    personal spans and at another on others; the rates start from the labelers'
    signs and keep a prior of two spans of them, so that none turns round."""
    out = {}
    sign = np.array([-1 if name in AGAINST else 1 for name in LABELERS])
    for form in range(len(FORMS)):
        rows = [(v, n) for f, v, n in patterns if f == form]
        if not rows:
            continue
        fired = np.array([[v >> k & 1 for k in range(len(LABELERS))] for v, _ in rows], dtype=float)
        count = np.array([n for _, n in rows], dtype=float)
        prior_yes, prior_no = np.where(sign > 0, 0.5, 0.05), np.where(sign > 0, 0.05, 0.5)
        yes, no, share = prior_yes, prior_no, 0.2
        for _ in range(rounds):
            log_yes = np.log(share) + fired @ np.log(yes) + (1 - fired) @ np.log1p(-yes)
            log_no = np.log1p(-share) + fired @ np.log(no) + (1 - fired) @ np.log1p(-no)
            p = 1 / (1 + np.exp(np.clip(log_no - log_yes, -500, 500)))
            with_yes, with_no = count * p, count * (1 - p)
            yes = np.clip((with_yes @ fired + 2 * prior_yes) / (with_yes.sum() + 2), 1e-4, 1 - 1e-4)
            no = np.clip((with_no @ fired + 2 * prior_no) / (with_no.sum() + 2), 1e-4, 1 - 1e-4)
            # a labeler never speaks for the class that it votes against
            yes, no = np.where(sign > 0, np.maximum(yes, no), yes), np.where(sign > 0, no, np.maximum(yes, no))
            share = min(max((with_yes.sum() + 0.4) / (count.sum() + 2), 1e-4), 1 - 1e-4)
        out |= {(form, v): float(x) for (v, _), x in zip(rows, p)}
    return out


@dataclass
class SpanModel:
    """Logistic weights; the last one is the constant."""

    weights: np.ndarray

    def chance(self, rows: list[list[int]]) -> np.ndarray:
        score = np.array([self.weights[r].sum() for r in rows]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(score, -500, 500)))


def fit(rows: list[list[int]], chance: np.ndarray, weight: np.ndarray, steps: int = 400, penalty: float = 1e-4) -> SpanModel | None:
    """Weighted logistic regression on probabilities, by Adam. Both classes get
    the same total weight. None without spans of both classes."""
    if not len(rows) or chance.max() < 0.5 or chance.min() > 0.5:
        return None
    sure = chance > 0.5
    weight = weight / np.where(sure, weight[sure].sum(), weight[~sure].sum()) / 2
    size = np.array([len(r) for r in rows])
    flat, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), size)
    w, m, v = np.zeros(N_FEATURES + 1), np.zeros(N_FEATURES + 1), np.zeros(N_FEATURES + 1)
    for step in range(1, steps + 1):
        score = np.bincount(row, w[flat], len(rows)) + w[-1]
        off = weight * (1 / (1 + np.exp(-np.clip(score, -500, 500))) - chance)
        grad = np.append(np.bincount(flat, off[row], N_FEATURES), off.sum()) + penalty * w
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return SpanModel(w)


# --- the job -------------------------------------------------------------------------

_BASE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.list_(pa.struct([("form", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("is_base", pa.bool_()),
                             ("votes", pa.int32()), ("features", pa.list_(pa.int32()))]))
_BASE_SQL = "array<struct<kind:string,start:bigint,end:bigint>>"
_FOUND_SQL = "array<struct<form:int,start:bigint,end:bigint,is_base:boolean,votes:int,features:array<int>>>"
_ROWS = 64


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("form", "start", "end", "is_base", "votes", "features")
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            found = [scan_text(t or "") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                part.column(0),
                pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in base] for base, _ in found], _BASE),
                pa.array([[dict(zip(names, x)) for x in spans] for _, spans in found], _FOUND)], names=["doc_id", "base", "found"])


def _train(found: DataFrame, scratch: Scratch, sample_spans: int) -> SpanModel | None:
    spans = found.select(F.explode("found").alias("s")).select("s.form", "s.votes", "s.features")
    forms = scratch.write(spans.groupBy("form", "votes", "features").agg(F.count("*").alias("n")), "forms")
    patterns = forms.groupBy("form", "votes").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()
    if not patterns:
        return None
    chance = reliabilities([(r["form"], r["votes"], r["n"]) for r in patterns])
    quota = max(1, sample_spans // len(patterns))
    # distinct candidates of least hash: first those below a cut that leaves about twice the quota
    cut = [(r["form"], r["votes"], min(1 << 30, int((1 << 30) * (2 * quota + 20) / r["kinds"]))) for r in patterns]
    cuts = found.sparkSession.createDataFrame(cut, "form int, votes int, cut bigint")
    marked = forms.withColumn("mark", F.pmod(F.xxhash64("form", "votes", "features"), F.lit(1 << 30)))
    rank = Window.partitionBy("form", "votes").orderBy("mark", "features")
    few = marked.join(F.broadcast(cuts), ["form", "votes"]).where("mark <= cut").withColumn("rank", F.row_number().over(rank))
    taken = few.where(F.col("rank") <= quota).select("form", "votes", "features", "n").collect()
    scratch.drop(forms)
    taken.sort(key=lambda r: (r["form"], r["votes"], r["features"]))
    held = {}
    for r in taken:
        held[r["form"], r["votes"]] = held.get((r["form"], r["votes"]), 0) + r["n"]
    total = {(r["form"], r["votes"]): r["n"] for r in patterns}
    key = [(r["form"], r["votes"]) for r in taken]
    return fit([r["features"] for r in taken], np.array([chance[k] for k in key]),
               np.array([r["n"] * total[k] / held[k] for r, k in zip(taken, key)], dtype=float))


def _decide(model: SpanModel | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for base, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                more = [s for s in found if not s["is_base"]] if model is not None else []
                if more:
                    chance = model.chance([s["features"] for s in more])
                    added = sorted((s["form"], s["start"], s["end"]) for s, p in zip(more, chance) if p > 0.5)
                    base = base + [{"kind": FORMS[f], "start": a, "end": b} for f, a, b in added]
                out.append(base)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _BASE)], names=["doc_id", "spans"])
    return run


def personal_data(docs: DataFrame, sample_spans: int = SAMPLE_SPANS) -> DataFrame:
    """``doc_id, spans``: array of (kind, start, end) of every document, by
    kind as in ``KINDS``, then start."""
    scratch = Scratch(docs.sparkSession, "personal-data")
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = scratch.write(texts.mapInArrow(_scan, f"doc_id {kind}, base {_BASE_SQL}, found {_FOUND_SQL}"), "found")
    return found.mapInArrow(_decide(_train(found, scratch, sample_spans)), f"doc_id {kind}, spans {_BASE_SQL}")


def digest(found: DataFrame) -> DataFrame:
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(personal_data(read_table(spark, sf_dir, "documents")))
