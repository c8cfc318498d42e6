"""Personal data, filter audit and centroid clustering against brute force."""
import collections
import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import centroids, filter_audit, sanitise
from tidewater.llm.common import Scratch
from tidewater.llm.queries import QUERIES

CLASH = ["row", "id", "part", "digest", "A", "hash", "term", "kind", "cluster", "y", "spans2"]
WORDS = re.compile(r"[^\x20\x09-\x0D]+")

# -- personal data -----------------------------------------------------------------------------
PATTERNS = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def _digits(value):
    return re.sub("[^0-9]", "", value)


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


HOLDS = [lambda v: True, lambda v: all(int(p) <= 255 for p in v.split(".")),
         lambda v: 16 <= len(_digits(v)) <= 19 and _luhn(_digits(v)), lambda v: 8 <= len(_digits(v)) <= 15]


def _base(text):
    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text or "") if HOLDS[k](m.group())]


def test_base_spans_are_the_patterns_matches():
    rng = random.Random(7)
    parts = ["a", ".", "@", "1", "2", "+", "-", " ", "_", "(", "é", "4111111111111111", "1.2.3.4", "a@b.c", "300", "00255"]
    found = 0
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert sanitise.base_spans(text) == _base(text), text
        found += len(_base(text))
    assert found > 10_000


@pytest.mark.parametrize("text", ["a" * 1_000_000, "1" * 1_000_000, "1." * 300_000, "a@" * 300_000, "+1" * 300_000, "+" + "1" * 1_000_000 + "("])
def test_long_runs_take_linear_time(text):
    assert all(e <= len(text) for _, _, e in sanitise.base_spans(text))


def _pii_texts():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(4, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = [prose(30) for _ in range(60)]
    texts += [f"{prose(9)} Zorblatt-9, {prose(2)} ana@corp.example.org {prose(9)}" for _ in range(5)]   # tells of the address
    texts += [f"{prose(9)} common {prose(2)} bob@corp.example.org {prose(9)}" for _ in range(5)]
    texts += [f"{prose(9)} common {prose(20)}" for _ in range(20)]                                       # and stands elsewhere
    copy = f"{prose(9)} passage {prose(2)} 10.20.30.40 {prose(9)}"
    texts += [copy] * 6                                                                                  # one surrounding, however often
    texts += [f"é{prose(3)} ZORBLATT-9!", None, "", " \n", "word " * 30_000, "x" * 3000, "1.2.3.4 " * 300,
              "card 4111 1111 1111 1111 and +1 (212) 555-0100, 4111111111111112"]
    return texts


def _brute_terms(texts, reach, support, least):
    """Disclosing terms by counting over all texts."""
    term = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
    low = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    with_term, with_entity, both, places = (collections.defaultdict(set) for _ in range(4))
    for n, text in enumerate(texts):
        text = text or ""
        spans = _base(text)
        for m in term.finditer(text):
            with_term[low(m.group())].add(n)
        free = [(m.start(), m.end(), low(m.group())) for m in term.finditer(text) if all(m.end() <= s or m.start() >= e for _, s, e in spans)]
        for k, s, e in spans:
            name = k, text[s:e].lower() if k == 0 else _digits(text[s:e]) if k != 1 else text[s:e]
            with_entity[name].add(n)
            before, after = [x for x in free if x[1] <= s][-reach:], [x for x in free if x[0] >= e][:reach]
            near = [x[2] for x in before + after]
            for t in near:
                both[name, t].add(n)
                places[name, t].add(tuple(near))
    out = set()
    for (name, t), docs in both.items():
        p = len(with_entity[name]) / len(texts)
        if len(places[name, t]) >= support and p < 1:
            if math.log2(len(docs) / len(with_term[t]) / p) / -math.log2(p) >= least:
                out.add(t)
    return out


@pytest.mark.parametrize("bits, least", [(6, 0.9), (sanitise.BITMAP_BITS, 0.9), (sanitise.BITMAP_BITS, 0.4)])  # a full bitmap changes nothing
def test_disclosing_terms(spark, monkeypatch, bits, least):
    monkeypatch.setattr(sanitise, "BITMAP_BITS", bits)
    monkeypatch.setattr(sanitise, "GROUP", 100)  # a text below has more spans
    texts = _pii_texts()
    rows = [(i if i % 9 else None, t, *["x"] * len(CLASH)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASH)).repartition(4)
    want_terms = _brute_terms(texts, sanitise.REACH, sanitise.SUPPORT, least)
    with Scratch(spark, "test-pii") as keep:
        assert {r.term for r in sanitise.disclosing_terms(docs, keep, disclosure=least).collect()} == want_terms
        got = collections.Counter((r.id, tuple((s.kind, s.start, s.end) for s in r.spans))
                                  for r in sanitise.scan(docs, keep, disclosure=least).collect())
    want = collections.Counter()
    for r in rows:
        found = [(4, m.start(), m.end()) for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", r[1] or "")
                 if m.group().lower() in want_terms]
        want[r[0], tuple(_base(r[1]) + found)] += 1
    assert got == want


def test_copies_and_common_words_disclose_nothing():
    strict = _brute_terms(_pii_texts(), sanitise.REACH, sanitise.SUPPORT, 0.9)
    assert "zorblatt" in strict and not strict & {"common", "passage"}


def test_sanitised_texts(spark):
    texts = _pii_texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, `_doc` string")
    with Scratch(spark, "test-pii") as keep:
        got = {r.doc_id: r for r in sanitise.sanitised(docs, keep, disclosure=0.9).collect()}
    assert len(got) == len(texts) and got[0].sanitised == texts[0] and got[0]["_doc"] == "x"
    assert all((r.sanitised is None) == (r.text is None) for r in got.values())
    for r in got.values():
        assert not _base(r.sanitised) and "zorblatt" not in (r.sanitised or "").lower()
    last = got[len(texts) - 1].sanitised
    assert last == "card [card ending 1111] and [phone ending 00], 4111111111111112"
    assert "[email at org]" in got[60].sanitised


def test_pii_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_pii_sanitise"](spark, str(tmp_path))
    assert got.count() == 0 and got.columns[:2] == ["doc_id", "n_email"]


def test_pii_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op11_pii_sanitise"](spark, sf).collect()
    assert len(got) == len(docs)
    flagged = 0
    for r in got:
        base = _base(docs[r.doc_id])
        text = ",".join(f"{sanitise.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans.startswith(text)
        flagged += bool(base)
    assert flagged


# -- filter audit ---------------------------------------------------------------------------------
def _audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)

    def fails(i, t):
        w = WORDS.findall(t)
        return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > first[t]}
    parts = collections.defaultdict(list)
    for i, t, s in rows:
        parts[s or ""].append(({f for f, x in fails(i, t or "").items() if x}, i in good, i in toxic))
    out, shapley = {}, collections.Counter()
    for part, own in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = own
            for n, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                out[part, order, n + 1] = [len(left), len(gone), sum(f in r[0] for r in own) - len(gone), sum(r[0] == {f} for r in own),
                                           sum(r[1] for r in gone), sum(r[2] for r in gone)]
                shapley[part, f] += len(gone)
    return {(p, o, n, *v, shapley[p, o[n - 1]]) for (p, o, n), v in out.items()}


def test_filter_audit(spark, monkeypatch):
    rng = random.Random(3)
    texts = [None, "", " \t", "A" * 50, "a # b"]
    texts += [" ".join(rng.choice(["ab", "cd", "Éf", "GH"]) + str(rng.randint(0, top)) for _ in range(rng.choice([5, 199, 200, 240])))
              + rng.choice(["", "", " $", "|"]) for top in (3, 100, 10_000) for _ in range(12)]
    texts += ["word " * 30_000, "x" * 100_000, "the same text"]
    rows = [(i, t, rng.choice([None, "", "a", "b"])) for i, t in enumerate(texts)]
    rows += [(rng.randrange(len(texts)), rng.choice(texts), "b") for _ in range(40)]
    rows += [(1000 + i, "the same text", "hot") for i in range(150)] + [(None, "the same text", "a"), (None, None, "a"), rows[3], rows[3]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(60)] + [(5, 1, 0), (5, 0, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(*r, *["x"] * len(CLASH)) for r in rows],
                                 "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASH)).repartition(3)
    marks = spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, `id` string")
    want = _audit(rows, labels)
    for share, bucket in ((1024, 250_000), (10, 50)):  # also with hot digests and several buckets
        monkeypatch.setattr(filter_audit, "HOT_SHARE", share)
        monkeypatch.setattr(filter_audit, "BUCKET_ROWS", bucket)
        got = [tuple(r) for r in filter_audit.audit(docs, marks).collect()]
        assert len(got) == len(want) == 4 * 600 and set(got) == want
    assert filter_audit.audit(docs.filter("1 = 0"), marks).count() == 0
    assert filter_audit.audit(docs, marks.filter("1 = 0")).agg(F.sum("good_lost")).first()[0] == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("audit_")]


def test_id_relations_are_joined_without_a_shuffle(spark):
    with filter_audit._Relations(spark) as keep:
        a, b = (keep.relation(spark.range(0, 1000, s).withColumnRenamed("id", "row"), 4) for s in (1, 3))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = spark.sql(f"select * from {a} left anti join {b} using (row)")._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


# -- centroid clustering ----------------------------------------------------------------------------
def test_transform_is_exact():
    rng = np.random.default_rng(2)
    x = rng.integers(-centroids.LIMIT, centroids.LIMIT, (50, 64))
    assert (centroids.inverse(centroids.transform(x)) == x).all()
    basis = centroids.transform(np.eye(64, dtype=np.int64)).T
    assert (np.diff(basis, axis=1) != 0).sum(axis=1).tolist() == list(range(64))  # coarse to fine


@pytest.mark.parametrize("top", [2, 40, centroids.LIMIT - 1])
def test_progressive_search_is_exact(top):
    rng = np.random.default_rng(top)
    x = rng.integers(-top, top, (400, 64))
    c = x[rng.integers(0, 400, 16)].copy()
    c[7] = c[3]                                                                   # a tie: the smaller number
    d = ((x[:, None].astype(object) - c[None]) ** 2).sum(axis=2)
    own, distance = centroids.nearest(centroids.transform(x), centroids.transform(c))
    assert own.tolist() == [min(range(16), key=lambda j: (r[j], j)) for r in d] and distance.tolist() == d.min(axis=1).tolist()


def _clustered(rows, k=16, rounds=3):
    kept = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()))
    now = [list(v) for _, v in order[:k]]
    for n in range(rounds + 1):
        own = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(now)) for _, v in kept]
        if n < rounds:
            for j in range(len(now)):
                part = [v for (_, v), (_, o) in zip(kept, own) if o == j]
                if part:
                    now[j] = [sum(x) // len(part) for x in zip(*part)]
    total = collections.Counter()
    for d, j in own:
        total[j] += d
    return collections.Counter((i, j, d, total[j], sum(total.values()), hashlib.sha256(",".join(map(str, now[j])).encode()).hexdigest())
                               for (i, _), (d, j) in zip(kept, own))


def test_centroid_clusters(spark):
    rng = random.Random(4)
    vec = lambda: [rng.uniform(-2, 2) for _ in range(64)]
    rows = [(i, vec()) for i in range(150)] + [(300, [0.0] * 64), (301, [-1 / 64] * 64)]
    rows += [(400 + i, rows[0][1]) for i in range(40)] + [rows[1]] * 3                                    # ties and repeated rows
    bad = [(500, None), (501, []), (502, [1.0] * 63), (503, [1.0] * 65), (504, [None] + [1.0] * 63), (505, [math.nan] * 64),
           (506, [math.inf] + [0.0] * 63)]
    schema = "vec_id long, embedding array<double>, `id` string, `y` string, cluster string"
    for own in (rows + [(None, [0.5] * 64)] + bad, rows[:5], bad, []):
        got, final = centroids.cluster(spark.createDataFrame([(*r, "x", "x", "x") for r in own], schema).repartition(3))
        want = _clustered(own)
        assert collections.Counter(tuple(r) for r in got.collect()) == want
        assert len(final) == min(16, sum(want.values()))
    wide = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit exact sums"):
        centroids.cluster(wide)
