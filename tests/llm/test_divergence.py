"""Source divergence against exact counts in plain Python, and skybands against their definition."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string, value string, n int"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute_force(rows, k=200, min_docs=3):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        count[lang, source].update(terms(text))
        docs[lang].update(set(terms(text)))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        share = {}
        for key in [*sources, None]:
            n = Counter()
            for source in sources if key is None else [key]:
                n.update({t: count[lang, source][t] for t in kept})
            size = sum(n.values()) + len(kept)
            share[key] = {t: 1 + 10**9 * (n[t] + 1) // size for t in kept}
        for a in sources:
            far = {b: sum((share[a][t] - share[b][t]) ** 2 // share[b][t] for t in kept) for b in sources if b != a}
            for r, b in enumerate(sorted(far, key=lambda b: (-far[b], b.encode())), 1):
                out.add((lang, a, "pair", b, far[b], r))
            own = {t: (share[a][t] - share[None][t]) ** 2 // share[None][t] for t in kept if count[lang, a][t] and share[a][t] > share[None][t]}
            for r, t in enumerate(sorted(own, key=lambda t: (-own[t], t.encode()))[:k], 1):
                out.add((lang, a, "term", t, own[t], r))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = [rng.choice(["a", "É", "zz", "Ab", "日本", "ß", "q"]) + rng.choice(["", "x", "ÿ", "Q", "lo"]) * rng.randint(0, 3) for _ in range(120)]
    out = []
    for k in range(260):
        # A third of the rows in one source; some languages with few documents.
        source = "hot" if k % 3 == 0 else rng.choice(["s1", "s2", "é", None, ""])
        lang = rng.choice(["en"] * 8 + ["de", None])
        mine = words[:40] if source == "hot" else words
        out.append((k, " ".join(rng.choice(mine) for _ in range(rng.randint(0, 40))), lang, source, "clash", 7))
    out += [out[5], out[5], (None, None, None, None, None, None), (900, "", "xx", "alone", None, 1), (901, "one two", "xx", "other", None, 1)]
    out += [(902, "123 __ -- \x00\x7f@[`{", "yy", "s1", None, 1), (903, "İstanbul K ſ Á  b", "en", "s1", None, 1), (904, "long " * 50000, "en", "s2", None, 1)]
    return out


@pytest.mark.parametrize("k", [200, 5])
def test_audit_against_brute_force(spark, rows, k):
    got = divergence.audit_sources(spark.createDataFrame(rows, SCHEMA).repartition(7), k)
    assert {tuple(r) for r in got.collect()} == brute_force(rows, k)
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"


def test_small_tables_and_parts(spark, rows, monkeypatch):
    """The same result when tasks hold little, pass parts on early and compare languages in many parts."""
    for name, value in (("_KEPT_ROWS", 64), ("_CELLS", 40), ("_BLOCK", 3), ("PART_CELLS", 50), ("_SLICE", 300)):
        monkeypatch.setattr(divergence, name, value)
    got = divergence.audit_sources(spark.createDataFrame(rows, SCHEMA).repartition(3), 4)
    assert {tuple(r) for r in got.collect()} == brute_force(rows, 4)


def test_empty_table(spark):
    assert divergence.audit_sources(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_are_exact(spark):
    cases = [(0, 1), (5, 6), (10**14 - 1, 10**14), (123456789012345, 9 * 10**14 + 7), (8999999999999998, 8999999999999999), (0, 0)]
    rows = spark.createDataFrame(cases, "n bigint, total bigint").select("n", "total", divergence.share(F.col("n"), F.col("total")).alias("p")).collect()
    assert all(r["p"] == 1 + 10**9 * (r["n"] + 1) // max(1, r["total"]) for r in rows)


def test_skyband_is_its_definition():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = int(rng.integers(1, 1500))
        count, everywhere, place = rng.integers(1, 20, n), rng.integers(1, 30, n), rng.permutation(n)
        k = int(rng.integers(1, 9))
        over = ((count >= count[:, None]) & (everywhere <= everywhere[:, None]) & (place < place[:, None])).sum(axis=1)
        assert sorted(divergence.skyband(count, everywhere, place, k)) == np.flatnonzero(over < k).tolist()
