"""Exact dedup, source divergence and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from threadpulse.llm import edit_lattice, level_products, quotient_dedup

# --- exact dedup


@pytest.mark.parametrize("width", [0, 1, 8, 9, 58, 64])
def test_filters_keep_and_merge_counts(width):
    rng = np.random.default_rng(width)

    def some():
        values = np.unique(rng.integers(0, (1 << width) - 1, 300, dtype=np.uint64, endpoint=True))
        return values, rng.choice([1, 1, 2, 255, 256, 257, 70_000, 1 << 40], len(values)).astype(np.uint64)

    (a, a_counts), (b, b_counts) = some(), some()
    one, two = quotient_dedup.encode(a, a_counts, width), quotient_dedup.encode(b, b_counts, width)
    back, counts, bits = quotient_dedup.decode(one)
    assert bits == width and (back == a).all() and (counts == a_counts).all()
    want = Counter(dict(zip(a.tolist(), a_counts.tolist(), strict=True)))
    want.update(dict(zip(b.tolist(), b_counts.tolist(), strict=True)))
    back, counts, _ = quotient_dedup.decode(quotient_dedup.merge(one, two))
    assert dict(zip(back.tolist(), counts.tolist(), strict=True)) == want
    assert back.tolist() == sorted(want)


TEXTS = ["a b", "a  b", "a\tb", " a b", "a b ", "", None, " ", "\n\t", " ", "a b", "x " * 40_000, "x\n" * 40_000, "c"]


@pytest.fixture(scope="module")
def copies(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "hot text") for i in range(60)]
    rows += [(200 + i, f"text {i % 25}") for i in range(50)] + [(3, " a b"), (3, " a b"), (3, "c"), (None, "c"), (None, "n")]
    random.Random(5).shuffle(rows)
    rows = [(i, t, "clash", 1, False) for i, t in rows]
    ddl = "doc_id long, text string, fingerprint string, keep_id int, own_text_sha256 boolean"
    return rows, spark.createDataFrame(rows, ddl).repartition(5)


def _equal_groups(rows):
    plain = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, *_ in rows]
    ids = defaultdict(list)
    for i, t in plain:
        ids[t].append(i)
    out = []
    for i, t in plain:
        keep = min((x for x in ids[t] if x is not None), default=None)
        out.append((i, keep, len(ids[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("bits", "most", "rows_per_task"), [(64, 1000, 1000), (3, 1000, 10), (0, 0, 1), (64, 0, 10)])
def test_exact_duplicates(copies, bits, most, rows_per_task):
    rows, docs = copies
    found = quotient_dedup.exact_duplicates(docs, bits, most, rows_per_task)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == _equal_groups(rows)


def test_filters_over_partitions_count_all_rows(spark, copies):
    fingerprints = spark.range(1000).selectExpr("xxhash64(id % 300) AS f").repartition(7)
    whole = quotient_dedup.merged(quotient_dedup.filters(fingerprints, 6))
    assert whole.count() == whole.select("shard").distinct().count()
    found = {r["fingerprint"]: r["n"] for r in quotient_dedup.repeated(whole).collect()}
    assert found == {r["f"]: r["count"] for r in fingerprints.groupBy("f").count().where("count > 1").collect()}


def test_deduplicated_rows(spark, copies):
    rows, docs = copies
    left = quotient_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    groups = _equal_groups(rows)
    assert left.count() == len({(i, digest) for i, _, _, kept, digest in groups if kept})
    assert quotient_dedup.exact_duplicates(docs.limit(0)).count() == 0


# --- source divergence


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(8)
    words = ["Ab", "ab", "cd", "été", "É", "x1y", "zz", "q", "lang"]
    rows = []
    for i in range(120):
        text = " ".join(rng.choices(words, [8, 5, 4, 3, 2, 2, 1, 1, 1], k=rng.randint(0, 30)))
        rows.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", "s4", "", None])))
    rows += [(500, "alone here", "xx", "s1"), (501, None, "xx", "s2"), (502, None, "en", "empty"), (503, "zz " * 30_000, "fr", "s2")]
    rows += [rows[0], rows[0]]
    rows = [(*r, 5, "clash") for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, p int, term string")
    return rows, docs.repartition(4)


def _counted(rows):
    docs = defaultdict(Counter)
    counts = defaultdict(Counter)
    groups = set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: {t for t, n in docs[lang].items() if n >= 3} for lang, _ in groups}
    return groups, kept, {g: {t: n for t, n in counts[g].items() if t in kept[g[0]]} for g in groups}


def _divergence(rows, top):
    groups, kept, counts = _counted(rows)

    def share(found, lang, t):
        return 1 + 10**9 * (found.get(t, 0) + 1) // (sum(found.values()) + len(kept[lang]))

    out = []
    for lang, source in groups:
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])
        p = {t: share(counts[lang, source], lang, t) for t in kept[lang]}
        pairs = []
        for other in {s for x, s in groups if x == lang} - {source}:
            q = {t: share(counts[lang, other], lang, t) for t in kept[lang]}
            pairs.append((sum((p[t] - q[t]) ** 2 // q[t] for t in p), other))
        q = {t: share(whole, lang, t) for t in p}
        terms = [((p[t] - q[t]) ** 2 // q[t], t) for t in p if counts[lang, source].get(t) and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize(("top", "entries", "sources"), [(200, 200_000, 64), (2, 3, 2), (200, 5, 1)])
def test_divergence(tongues, top, entries, sources):
    rows, docs = tongues
    found = level_products.audit(docs, top, entries, sources)
    assert sorted(tuple(r) for r in found.collect()) == _divergence(rows, top)


def test_joint_tables(tongues, monkeypatch):
    rows, docs = tongues
    terms = level_products.kept_terms(docs)
    groups = level_products.totals(docs, terms)
    found = {tuple(r)[:5]: r["terms"] for r in level_products.joint_tables(terms, groups, 4, 2).collect()}
    _, kept, counts = _counted(rows)
    want = Counter()
    for (lang, a), (other_lang, b) in itertools.permutations(counts, 2):
        if lang == other_lang:
            want.update((lang, a, counts[lang, a][t], b, counts[lang, b][t]) for t in counts[lang, a].keys() & counts[lang, b].keys())
    assert found and all(want[k] == n for k, n in found.items())
    turned = {(lang, b, y, a, x): n for (lang, a, x, b, y), n in found.items()}
    assert found | turned == dict(want)


def test_products_in_parts_add_up(monkeypatch):
    rng = np.random.default_rng(2)
    entries = {"term": np.repeat(np.arange(50), 6), "source": np.tile(np.arange(6), 50)}
    entries |= {"n": rng.integers(1, 4, 300), "block": np.tile([0, 0, 0, 1, 1, 1], 50)}
    entries["p"] = entries["n"] * 10 + 1
    zero = {"block": np.array([0, 0, 0, 1, 1, 1]), "p": np.ones(6, np.int64)}
    sides = [level_products._Side(b, entries, zero) for b in (0, 1)]

    def cells():
        out = Counter()
        for a, b, n in level_products._products(*sides, 50):
            out.update(dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True)))
        return out

    whole = cells()
    assert sum(whole.values()) == 50 * 9
    monkeypatch.setattr(level_products, "PRODUCTS", 7)
    assert cells() == whole


def test_divergence_of_nothing(tongues):
    assert level_products.audit(tongues[1].limit(0)).count() == 0


# --- conversation repair



def _best(rows):
    """Edits by layers: (cost, audit, lines) of each state; states are what came last."""

    def nexts(state):
        return ("user", "u") if state != "u" else ("assistant", "a")

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                name, to = nexts(state)
                label = (cost + 3, audit + "I", [*lines, f"{name}:"])
                best[to] = min(best.get(to, label), label)
        return best

    best = {"": (0, "", [])}
    for role, text, fault in rows:
        new = defaultdict(list)
        for state, (cost, audit, lines) in inserted(best).items():
            new[state].append((cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            name, to = nexts(state)
            new[to].append((cost + 3 + more, audit + "R", [*lines, f"{name}:{text}"]))
            if role[:1] == to or (role[:1] == "s" and state == ""):
                new[role[:1]].append((cost + more, audit + "K", [*lines, f"{role}:{text}"]))
        best = {state: min(paths) for state, paths in new.items()}
    return min(label for state, label in inserted(best).items() if state in ("", "a"))


def _broken(rows):
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)


def _repaired(rows, breaking):
    by_conv = {r[0]: [] for r in rows}
    for conv, *rest in breaking(rows):
        by_conv[conv].append(tuple(rest))
    out = []
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in own:
            body = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = _best([(role, text, f) for (_, role, text), f in zip(own, faults, strict=True)])
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def _conversations(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", ["user", "assistant"][turn % 2], ["user", "assistant"][turn % 2], "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "Fine! ", " \n", "", None, " ", "Why?\v", "Là", f"No. {turn}", f"turn {turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 5, None]), role, text))
    return rows


@pytest.mark.parametrize(("piece_rows", "ranges"), [(1024, None), (3, 6), (1, 2)])
def test_repair(spark, piece_rows, ranges):
    rows = _conversations(piece_rows, 40, 9) + [(900, t, "user", "same.") for t in (1, 1, 1, 2, 2, 7)]
    rows += [(901, None, "assistant", "x" * 100_000), (902, 3, "user", "word " * 50_000)]
    table = spark.createDataFrame([(*r, "clash", 0) for r in rows], "conv_id long, turn long, role string, text string, present string, piece int")
    table = table.repartition(3)
    for prepared, breaking, present in ((edit_lattice.damaged(table), _broken, "present"), (table, None, None)):
        plain = breaking or (lambda rs: ((c, t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in rs))
        found = edit_lattice.audits(edit_lattice.repaired(prepared, present, piece_rows, ranges))
        assert sorted((tuple(r) for r in found.collect()), key=repr) == _repaired(rows, plain)


def test_repair_of_one_long_conversation(spark):
    """A conversation over all ranges, with a row that most others repeat."""
    rows = [(7, t, ["user", "assistant"][t % 2], f"line {t}." if t % 4 == 0 else "again") for t in range(1500)]
    rows += [(7, None, "user", "copy.")] * 700
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    repairs = edit_lattice.repaired(table, piece_rows=100, ranges=8)
    assert repairs.count() > 20
    assert [tuple(r) for r in edit_lattice.audits(repairs).collect()] == _repaired(rows, lambda rs: rs)
    turns = [t for r in repairs.orderBy("piece").collect() for t in r["turns"]]
    assert [t["role"] for t in turns] == ["user", "assistant"] * (len(turns) // 2)


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert edit_lattice.audits(edit_lattice.repaired(edit_lattice.damaged(empty), "present")).count() == 0


def test_search_from_both_ends():
    for k in range(4):
        for codes in map("".join, itertools.product("sSuUaxXbd", repeat=k)):
            rows = [(c.lower(), "", {"b": "blank", "d": "duplicate"}.get(c, "truncated" if c.isupper() else "")) for c in codes]
            assert edit_lattice.cheapest(codes, 0, (0, 3)) == _best(rows)[:2], codes
