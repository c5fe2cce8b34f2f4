"""Personal data: base patterns, and identifiers found by contexts that the patterns' finds induce."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .encode import split_batches

KINDS = ("email", "ip", "card", "phone")
#: Rounds of scoring, distinct seeds a pattern needs, weight of doubt in its score, and what a score must reach.
ROUNDS, SUPPORT, DOUBT, CONFIDENT = 3, 3, 1.0, 0.8

_DIGITS = re.compile("[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Shapes of identifiers which the base patterns don't take, looked at only in a learned context.
_LOOSE = {
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\.| \. |\[\.\])[0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])\(?[0-9][\x20().0-9-]{6,18}[0-9](?![0-9])"),
}
#: An address of the loose shape: its sign, and what may stand behind it.
_AT = re.compile(r" ?(?:@|\(at\)|\[at\]| at ) ?")
_LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+ ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9.-]*[A-Za-z0-9]")
_WORD = re.compile(r"\S+")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, from each '@' outwards, so that long words without one cost nothing."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of every base match that passes its check, in order."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _loose_emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses of the loose shape, from each sign outwards, so that long words cost nothing."""
    free = 0
    for at in _AT.finditer(text):
        start = at.start()
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _LOOSE_DOMAIN.match(text, at.end()) if start < at.start() else None
        free = m.end() if m else at.end()
        if m:
            yield start, m.end()


class _Words:
    """The words of a text by place; they are looked for once, and only where a span asks."""

    def __init__(self, text: str):
        self.text, self.spans = text, [m.span() for m in _WORD.finditer(text)]
        self.starts = [a for a, _ in self.spans]

    def before(self, at: int) -> list[str]:
        """The last two words before a place, the nearest last; a word that reaches over it counts up to it."""
        k = bisect_left(self.starts, at)
        return [self.text[a : min(b, at)] for a, b in self.spans[max(0, k - 2) : k]]

    def after(self, at: int) -> list[str]:
        """The first two words from a place on; a word that began earlier counts from it."""
        k = bisect_right(self.starts, at - 1)
        k -= k > 0 and self.spans[k - 1][1] > at
        return [self.text[max(a, at) : b] for a, b in self.spans[k : k + 2]]


def _patterns(words: _Words, start: int, end: int) -> list[str]:
    """The two words before a span, the two behind it, and one of each; lower-cased, digits as one sign."""
    before, after = words.before(start), words.after(end)
    out = [("<", *before)] if len(before) == 2 else []
    out += [(">", *after)] if len(after) == 2 else []
    out += [("=", before[-1], after[0])] if before and after else []
    return [re.sub("[0-9]+", "#", " ".join(p).lower()) for p in out]


def _value(kind: int, span: str) -> str:
    """What a span names, the same for all its shapes."""
    span = span.lower()
    if KINDS[kind] == "email":
        span = re.sub(r"\(at\)|\[at\]| at ", "@", span)
        return re.sub(r"\s+", "", re.sub(r"\(dot\)|\[dot\]| dot ", ".", span))
    if KINDS[kind] == "ip":
        return ".".join(re.findall("[0-9]+", span))
    return re.sub(r"[\s().-]+", "", span)


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds (base spans) and candidates of looser shape that touch no base span, each with its patterns.

    Time is linear in the text and its spans: base spans are held as merged intervals, in order.
    """
    starts, ends = [], []
    for a, _, b in base:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    spans = [(a, k, b, True) for a, k, b in base]
    digits = _DIGITS.search(text) is not None
    for k, kind in enumerate(KINDS):
        found = _loose_emails(text) if kind == "email" else (m.span() for m in _LOOSE[kind].finditer(text)) if digits else ()
        for a, b in found:
            at = bisect_left(starts, b)
            if at == 0 or ends[at - 1] <= a:
                spans.append((a, k, b, False))
    words, out = _Words(text) if spans else None, []
    for a, k, b, seed in spans:
        value = hashlib.blake2b(_value(k, text[a:b]).encode(), digest_size=16).hexdigest()
        out.append({"kind": k, "start": a, "end": b, "seed": seed, "patterns": _patterns(words, a, b), "value": value})
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, mentions): base spans of every whole text, and the seeds and candidates with contexts."""
    scratch = Scratch(docs.sparkSession, "pii")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, row string, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base string, mentions array<struct<kind:int,start:bigint,end:bigint,seed:boolean,patterns:array<string>,value:string>>"
    found_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.string())), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in split_batches(batches, "t"):
            base, found, rows = [], [], []
            for t in b.column("t").to_pylist():
                spans = base_spans(t or "")
                base.append(spans)
                found.append(mentions(t or "", spans))
                rows.append(hashlib.blake2b((t or "").encode("utf-8", "replace"), digest_size=16).hexdigest())
            counts = [pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(rows), *counts, pa.array([_joined(s) for s in base]), pa.array(found, found_type)],
                ["id", "row", *(f"n_{k}" for k in KINDS), "base", "mentions"],
            )

    rows = scratch.table(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, schema), "found")
    each = rows.filter(F.size("mentions") > 0).select("id", "row", F.explode("mentions").alias("m")).select("id", "row", "m.*")
    return rows, each


def learned(each: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, value) of candidates that are seeds elsewhere or that confident patterns reach.

    Edges of the pattern-instance graph are distinct (kind, pattern, value); an
    instance may have one without a pattern. In each round a pattern scores the sum of
    its instances' scores over their number and DOUBT, where at least SUPPORT different
    instances already count; an instance that is nowhere a seed scores the best of its
    patterns. Instances that are a seed anywhere stay at 1 behind every pattern. Copies
    of a text add no weight, since instances are counted once.
    """
    scratch = Scratch(each.sparkSession, "pii-graph")
    each = each.select("kind", "value", "seed", F.explode_outer("patterns").alias("pattern"))
    edges = scratch.table(each.groupBy("kind", "pattern", "value").agg(F.max("seed").alias("seed")), "pairs")
    known = edges.filter("seed").select("kind", "value", F.lit(True).alias("known")).distinct()
    edges = edges.join(known, ["kind", "value"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    edges = scratch.table(edges.withColumn("score", F.when(F.col("known"), 1.0).otherwise(0.0)), "edges")
    for k in range(rounds):
        patterns = edges.filter("pattern is not null").groupBy("kind", "pattern").agg(
            (F.sum("score") / (F.count(F.lit(1)) + DOUBT)).alias("conf"), F.count_if(F.col("score") >= CONFIDENT).alias("support")
        )
        good = patterns.filter((F.col("support") >= SUPPORT) & (F.col("conf") > 0))
        reached = edges.filter(~F.col("known")).join(good, ["kind", "pattern"]).groupBy("kind", "value").agg(F.max("conf").alias("best"))
        reached = scratch.table(reached, f"reached{k}")
        if reached.limit(1).count() == 0:
            break
        edges = edges.join(reached, ["kind", "value"], "left").select(
            "kind", "pattern", "value", "seed", "known", F.when(F.col("known"), 1.0).otherwise(F.coalesce(F.col("best"), F.lit(0.0))).alias("score")
        )
        edges = scratch.table(edges, f"edges{k + 1}")
    return edges.filter((F.col("score") >= CONFIDENT) & ~F.col("seed")).select("kind", "value").distinct()


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans).

    The counts and base_sha256 are of the base spans; `spans` has these and what
    the learned contexts add, as kind:start:end (code points, end exclusive) by
    start and kind, comma-joined. Contexts are the two words before a span, the two
    behind it, or one of each, whole words; a context that stands at several different
    seeds, and at little else, makes candidates of looser shape in it count too, as
    does a base span of the same identifier anywhere.

    Defined cases: null and empty texts have no spans; spans of different kinds may
    overlap; added spans never overlap base spans; repeated rows are answered each;
    rows that share an id with different texts keep their own spans; an empty table
    gives no rows; other columns are not read.
    """
    rows, each = extract(docs, id_col, text_col)
    added = each.filter(~F.col("seed")).join(learned(each), ["kind", "value"], "left_semi")
    added = added.select("id", "row", "kind", "start", "end").distinct().groupBy("id", "row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), lambda x: F.split(x, ":"))
    base = F.transform(parts, lambda x: F.struct(x[1].cast("bigint").alias("start"), (F.array_position(names, x[0]) - 1).cast("int").alias("kind"), x[2].cast("bigint").alias("end")))
    every = F.array_sort(F.concat(base, F.coalesce(F.col("more"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))))
    text = F.array_join(F.transform(every, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    added = added.withColumnRenamed("id", "_id").withColumnRenamed("row", "_row")
    out = rows.drop("mentions").join(added, rows["id"].eqNullSafe(added["_id"]) & (rows["row"] == added["_row"]), "left")
    return out.select(F.col("id").alias(id_col), *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), F.when(F.col("more").isNull(), F.col("base")).otherwise(text).alias("spans"))
