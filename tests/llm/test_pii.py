import hashlib
import re

import hypothesis.strategies as st
from hypothesis import given, settings

from feedlake.llm import pii

RULES = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute(text):
    out = []
    for k, rule in enumerate(RULES):
        for m in re.finditer(rule, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = (True, all(int(p) <= 255 for p in m[0].split(".")) if k == 1 else True, 12 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1290+-.@_% ()\né", max_size=60))
def test_base_spans_against_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_known_cases():
    for t in ("a@b.c_d@e.f", "4111 1111 1111 1111 x 4111-1111-1111-1112", "+1 (555) 010-9999 and 1.2.3.4.5", "é a@b.co", "999.1.1.1 0001.2.3.4", "x" * 5000 + "@", "1" * 9000):
        assert pii.base_spans(t) == brute(t)


def test_rows_and_counts(docs):
    got = {r["doc_id"]: r for r in pii.find_personal_data(docs).collect()}
    assert len(pii.find_personal_data(docs).collect()) == docs.count()
    base = brute(docs.filter("doc_id = 11").first()["text"])
    text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
    assert got[11]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[11]["spans"] == text
    assert (got[11]["n_email"], got[11]["n_ip"], got[11]["n_phone"]) == (1, 1, 1)
    assert got[4]["spans"] == got[5]["spans"] == ""
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_contexts_find_identifiers_that_the_patterns_miss(spark):
    rows = [(k, f"please call me: +1 (555) 010-{1000 + k} today") for k in range(40)]
    rows += [(100, "so call me: 555-010-7777 today"), (101, "the sum is: 555-010-8888 today"), (102, "about the sum is: 777-010-8888 too")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pii.find_personal_data(df).collect()}
    assert got[100]["spans"] == "phone:12:24" and got[100]["n_phone"] == 0
    assert got[101]["spans"] == "" and got[102]["spans"] == ""
    assert all(got[k]["spans"].startswith("phone:") for k in range(40))


def test_addresses_without_digits_or_signs(spark):
    rows = [(k, f"please write to: u{'abcdefghijklmnopqrst'[k]}@example.org") for k in range(20)]
    rows += [(100, "please write to: john(at)example(dot)com"), (101, "please write to: john at example.com")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[100] == "email:17:40" and got[101] == "email:17:36"


def test_a_seed_counts_behind_every_pattern(spark):
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004", "4012 8888 8888 1881"]
    rows = [(k, f"my card is {c} ok") for k, c in enumerate(cards)] + [(10 + k, f"pay it with {c.replace(' ', '.')} now") for k, c in enumerate(cards)]
    rows += [(20, "10.1.1.1 is here"), (21, "go to 10[.]1[.]1[.]1 now"), (22, "go to 1[.]01[.]1[.]1 now")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all("card:12:31" in got[10 + k] for k in range(3))
    assert got[21] == "ip:6:20" and got[22] == ""


def test_long_words_and_many_spans_take_linear_time():
    import time

    for text in ("x" * 100_000, " ".join(f"user{k}@example{k}.org" for k in range(20_000)), "a" * 50_000 + "@" + "b" * 50_000, "a at b " * 20_000, "1" * 100_000, "+1" * 50_000):
        began = time.time()
        found = pii.mentions(text, pii.base_spans(text))
        assert time.time() - began < 3


def test_words_around_a_span():
    words = pii._Words("one two:x@y.z, three 4 five")
    assert words.before(8) == ["one", "two:"] and words.after(13) == [",", "three"] and words.before(0) == [] and words.after(27) == []
    assert pii._patterns(words, 8, 13) == ["< one two:", "> , three", "= two: ,"]


def brute_learned(mentions):
    """The pattern-instance graph scored with plain dictionaries."""
    edges = {}
    for m in mentions:
        for p in m["patterns"] or [None]:
            edges[m["kind"], p, m["value"]] = edges.get((m["kind"], p, m["value"]), False) or m["seed"]
    known = {(k, v) for (k, _, v), seed in edges.items() if seed}
    score = {e: float((e[0], e[2]) in known) for e in edges}
    for _ in range(pii.ROUNDS):
        conf = {}
        for k, p in {(k, p) for k, p, _ in edges if p is not None}:
            own = [s for e, s in score.items() if e[:2] == (k, p)]
            if sum(s >= pii.CONFIDENT for s in own) >= pii.SUPPORT:
                conf[k, p] = sum(own) / (len(own) + pii.DOUBT)
        best = {}
        for k, p, v in edges:
            best[k, v] = max(best.get((k, v), 0.0), conf.get((k, p), 0.0))
        score = {e: 1.0 if (e[0], e[2]) in known else best[e[0], e[2]] for e in edges}
    return {(e[0], e[2]) for e, s in score.items() if s >= pii.CONFIDENT and not edges[e]}


def test_learned_spans_against_a_plain_graph(spark):
    import random

    rng = random.Random(3)
    frames = ["call me on {} please", "my number {} is new", "the total {} was paid", "ring {} or come"]
    texts = []
    for k in range(300):
        base = rng.random() < 0.7
        number = f"+1 (555) 01{rng.randrange(90):02d}-{rng.randrange(40):04d}" if base else f"555-01{rng.randrange(90):02d}-{rng.randrange(40):04d}"
        texts.append(rng.choice(frames[:2] if base else frames).format(number))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    _, each = pii.extract(docs)
    got = {(r["kind"], r["value"]) for r in pii.learned(each).collect()}
    want = brute_learned([m for t in texts for m in pii.mentions(t, pii.base_spans(t))])
    assert got == want and len(want) > 5
