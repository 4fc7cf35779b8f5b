"""The Pitman-Yor model: base scores by plain counting, a proper distribution, seating by brute force."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import pitman_yor as P
from millrace.llm.queries import QUERIES
from tests.conftest import DATA

DOC = "doc_id bigint, text string, score int, train boolean"


@pytest.fixture(autouse=True)
def few_sweeps(request, monkeypatch):
    """What does not depend on the seating is tested with few sweeps."""
    if "all_sweeps" not in request.keywords:
        monkeypatch.setattr(P, "BURN_IN", 1)
        monkeypatch.setattr(P, "SAMPLES", 2)


def words_of(text):
    low = (text or "").encode().lower().decode()
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [""]


def base_scores(rows):
    """(n_tokens, n_known, base score) of every text and the number of training tokens."""
    counts = Counter(w for _, t, learn in rows if learn for w in words_of(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for _, t, _ in rows:
        w = words_of(t)
        out.append((len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)))
    return out, n


def test_base_scores_equal_plain_counts(spark):
    got = {r["doc_id"]: r for r in QUERIES["op2_pitman_yor"](spark, DATA).collect()}
    rows = [(r["doc_id"], r["text"], not got[r["doc_id"]]["held_out"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want, n = base_scores(rows)
    assert len(got) == len(rows)
    for (i, _, _), (tokens, known, base) in zip(rows, want):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_held_out_texts_score_better_than_the_base(spark):
    got = QUERIES["op2_pitman_yor"](spark, "/root/testdata/sf0.01").where("held_out")
    r = got.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.avg((F.col("score") > F.col("base_score")).cast("int")).alias("share")).first()
    assert r["s"] > r["b"] and r["share"] > 0.9


def fitted(spark, rows):
    """The plain numbers of a model: counts, and a function for the probability of a word after a context."""
    table = spark.createDataFrame(rows, DOC)
    model = P.fit(table.select(F.col("doc_id").alias("id"), "text", "train"), P.BURN_IN, P.SAMPLES, 5)
    number = lambda w: P.xxhash.xxh64_intdigest(w.encode())
    pairs, counts = Counter(), Counter()
    for _, t, _, learn in rows:
        if learn:
            ws = words_of(t)
            counts.update(ws)
            pairs.update(zip(["", *ws], ws))
    # words and cells by the hashes of their words
    words, named = {}, {}
    vectors = [{r["slice"]: P._load(r["pack"]) for r in v.collect()} for v in model.vectors]
    for r in model.numbered.where(F.col("kind") == P.VOCABULARY).collect():
        hashes, n = P._load(r["pack"])
        for i, (h, k) in enumerate(zip(hashes.tolist(), n.tolist())):
            named[int(model.offsets.words[r["slice"]]) + i] = h
            own = [(v[r["slice"]], t) for v, t in zip(vectors, model.totals)]
            words[h] = {"n": k, "new": [1 + t.discount * x[0][i] for x, t in own], "q": [t.chance(x[1][i], x[2][i]) for x, t in own]}
    m = {}
    for r in model.state.where(F.col("kind") == P.OWN).collect():
        cu, cw, iu, iw, c, t, mean = P._load(r["pack"])
        for u, w, n, x in zip(cu[iu].tolist(), cw[iw].tolist(), c.tolist(), mean.tolist()):
            m[named[u], named[w]] = x
    assert {h: w["n"] for h, w in words.items() if w["n"]} == {number(w): n for w, n in counts.items()}

    def chance(u, w):
        never = [t.back / (1 + t.served) for t in model.totals]
        q = words[number(w)]["q"] if number(w) in words else never
        new = words[number(u)]["new"] if number(u) in words else [1] * len(q)
        own = m[number(u), number(w)] if pairs[u, w] > 1 else (1 - model.totals[0].discount) * pairs[u, w]
        return (own + np.mean([a * b for a, b in zip(q, new)])) / (1 + counts[u])

    return model, counts, pairs, chance


LEARNT = ["a b a c a b", "c a b b", "a", None, "B\tA b", "a a b once", "c c a", "a b a b d e"]


def test_probabilities_add_up_to_one_and_make_the_scores(spark):
    probes = ["a b", "zz a zz", "once a", "once once zz", "", "b c d e f a c b"]
    rows = [(i, t, 0, True) for i, t in enumerate(LEARNT)] + [(100 + i, p, 0, False) for i, p in enumerate(probes)]
    model, counts, pairs, chance = fitted(spark, rows)
    for context in [*counts, "zz"]:
        assert sum(chance(context, w) for w in [*counts, "zz"]) == pytest.approx(1.0, abs=1e-9)
    # a word met once counts once as a word and once as a context
    assert model.totals[0].known == len(counts) and model.totals[0].tokens == sum(counts.values())
    got = P.score_texts(spark.createDataFrame(rows, DOC), F.col("train"), block_rows=3).collect()
    for r, (_, t, _, _) in zip(sorted(got, key=lambda r: r["doc_id"]), rows):
        ws = words_of(t)
        assert r["score"] == pytest.approx(sum(math.log10(chance(u, w)) for u, w in zip(["", *ws], ws)), rel=1e-9)


def plain_gibbs(pairs, known, d, dp, sweeps, burn_in, seed):
    """Customer by customer: mean tables, and mean of new-table weight and parent probability, over the sweeps after ``burn_in``."""
    rng = random.Random(seed)
    rooms, parent = {}, {}

    def pick(weights):
        x = rng.random() * sum(weights)
        for i, v in enumerate(weights):
            x -= v
            if x < 0:
                return i
        return len(weights) - 1

    served, tables_of, tables = 0, Counter(), Counter()

    def q(w):
        n = sum(map(len, parent.values()))
        own = parent.get(w, [])
        return (sum(own) - dp * len(own) + (1 + dp * n) / (known + 1)) / (1 + served)

    def sit(at, w, d, fresh):
        at = at.setdefault(w, [])
        i = pick([s - d for s in at] + [fresh])
        if i == len(at):
            at.append(0)
        at[i] += 1
        return at[i] == 1

    def leave(at, w):
        i = pick(at[w])
        at[w][i] -= 1
        if not at[w][i]:
            del at[w][i]
            return True
        return False

    customers = [p for p, n in pairs.items() for _ in range(n)]
    total, rates = [], Counter()
    for sweep in range(sweeps):
        for u, w in customers:
            if sweep and leave(rooms[u], w):
                tables[u] -= 1
                served -= 1
                leave(parent, w)
            if sit(rooms.setdefault(u, {}), w, d, (1 + d * tables[u]) * q(w)):
                tables[u] += 1
                n = sum(map(len, parent.values()))
                sit(parent, w, dp, (1 + dp * n) / (known + 1))
                served += 1
        if sweep >= burn_in:
            total.append(served)
            for u in rooms:
                for w in parent:
                    own = rooms[u].get(w, [])
                    rates[u, w] += (sum(own) - d * len(own) + (1 + d * tables[u]) * q(w)) / (1 + sum(map(sum, rooms[u].values())))
    n = sweeps - burn_in
    return np.mean(total), np.std(total), {p: r / n for p, r in rates.items()}


@pytest.mark.all_sweeps
def test_sweeps_reach_what_customer_wise_sampling_reaches(spark):
    """Heavy cells of a small corpus: tables within three standard deviations, probabilities within 2 % of the log on average."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(vocabulary, [1 / (i + 1) ** 1.3 for i in range(40)], k=30)) for _ in range(60)]
    rows = [(i, t, 0, True) for i, t in enumerate(texts)]
    model, counts, pairs, chance = fitted(spark, rows)
    t = model.totals[0]
    mean, spread, rates = plain_gibbs(pairs, len(counts), t.discount, t.parent_discount, 60, 20, 1)
    assert abs(np.mean([x.served for x in model.totals]) - mean) < 3 * spread + 0.01 * mean
    ours = sum(n * math.log(chance(*p)) for p, n in pairs.items())
    theirs = sum(n * math.log(rates[p]) for p, n in pairs.items())
    assert ours == pytest.approx(theirs, rel=0.005)
    off = [abs(math.log(chance(*p) / rates[p])) for p in rates]
    assert np.mean(off) < 0.1


@pytest.mark.all_sweeps
@pytest.mark.parametrize("size,kinds", [(2_000, 50), (20_000, 500)])
def test_dropped_sweeps_forget_the_start(size, kinds):
    """Words that do not depend on their context mix slowest; from the start in use they come within 3 % of a long run."""
    rng = np.random.default_rng(3)
    u, w = (np.minimum(rng.zipf(1.3, size), kinds) - 1 for _ in range(2))
    cells, c = np.unique(np.column_stack([u, w]), axis=0, return_counts=True)
    d = (c == 1).sum() / ((c == 1).sum() + 2 * (c == 2).sum())
    key, stirling, totals = np.arange(len(c), dtype=np.uint64), P._log_stirling(P.EXACT, d), []
    tables = np.maximum(1, np.rint(c**d)).astype(int)
    for s in range(60):
        tw = np.bincount(cells[:, 1], tables, kinds)
        q = (tw - d * np.minimum(tw, 1) + 0.1) / (1 + tw.sum())
        fresh = (1 + d * np.bincount(cells[:, 0], tables, kinds))[cells[:, 0]] * q[cells[:, 1]]
        tables = P.seat(c, fresh, d, stirling, P._hashed(key, s))
        totals.append(tables.sum())
    kept = totals[P.BURN_IN - 1 : P.BURN_IN - 1 + P.SAMPLES]
    assert np.mean(kept) == pytest.approx(np.mean(totals[30:]), rel=0.03)


def test_blocks_are_bounded_in_rows_and_bytes(spark):
    rows = [(i, "w " * (3_000 if i % 3 == 0 else 10), True) for i in range(90)] + [(500, "v " * 40_000, True)]
    table = spark.createDataFrame(rows, "id int, text string, train boolean").coalesce(1)
    made = P._encoded(table, 4, 16, 64_000).where(F.col("kind") == P.TEXTS).collect()
    lengths = [P._load(r["pack"])[0] for r in made]
    assert sum(map(len, lengths)) == 91 and len({r["block"] for r in made}) == len(made)
    # a block ends with the text that reaches the bound
    assert all(len(n) <= 16 and (n[:-1].sum() * 2 <= 64_000) for n in lengths) and max(map(len, lengths)) == 16
    ids = [i for r in made for i in pa.ipc.open_stream(r["ids"]).read_all().column("id").to_pylist()]
    assert ids == [r[0] for r in rows]


def test_runs_agree_and_do_not_depend_on_blocks(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    learn = F.col("doc_id") % 3 != 0
    runs = [P.score_texts(table, learn, block_rows=n) for n in (16_384, 16_384, 7)]
    runs.append(P.score_texts(table.repartition(5), learn))
    first = {r["doc_id"]: r["score"] for r in runs[0].collect()}
    for run in runs[1:]:
        for r in run.collect():
            assert r["score"] == pytest.approx(first[r["doc_id"]], rel=1e-6)


def test_odd_rows(spark):
    rows = [(1, None, 1, True), (1, None, 1, True), (2, "", 1, None), (None, "x " * 40_000, 1, True), (3, "é É", 1, False)]
    table = spark.createDataFrame(rows, DOC)
    got = P.score_texts(table, F.col("train")).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"]) for r in got) == [(0, 40_001, 40_001), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 3, 1)]
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in got)
    assert P.score_texts(table.where("false"), F.col("train")).count() == 0
    untrained = P.score_texts(table, F.lit(False)).collect()
    assert {r["train_tokens"] for r in untrained} == {0}
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in untrained)


def test_contexts_are_the_words_before():
    texts = pa.array(["ab  c", None, "ab d\x0b"], pa.string())
    words, lengths, code = P.encode(pa.chunked_array([texts[:2], texts[2:]]))
    name = {w: int(np.searchsorted(words, np.uint64(P.xxhash.xxh64_intdigest(w.encode())))) for w in ("ab", "c", "d", "")}
    assert code.tolist() == [name[w] for w in ("ab", "c", "", "", "ab", "d", "")] and lengths.tolist() == [3, 1, 3]
    p = P.Tokens(lengths, np.array([True, False, True]), code, len(words))
    key, c = p.pairs()
    u, w = key // len(words), key % len(words)
    want = {("", "ab"): 2, ("ab", "c"): 1, ("c", ""): 1, ("", ""): 0, ("ab", "d"): 1, ("d", ""): 1}
    assert dict(zip(zip(u.tolist(), w.tolist()), c.tolist())) == {(name[a], name[b]): n for (a, b), n in want.items()}
    assert (np.diff(key) > 0).all() and set(p.keys().tolist()) == set(key.tolist())
    assert p.keys(2, 5).tolist() == p.keys().tolist()[2:5]
    assert p.counts()[0].sum() == 6 and p.counts()[1].sum() == 7


def test_packs_read_back():
    arrays = [np.array([], np.int64), np.array([5, 3, 70_000]), np.array([-1, 2]), np.array([0.5]), np.array([1 << 63], np.uint64), np.array([2], np.uint8)]
    for x, y in zip(arrays, P._load(P._dump(*arrays))):
        assert x.tolist() == y.tolist()


@pytest.mark.parametrize("tokens,slices", [(3, 16), (50, 2), (1 << 22, 1)])
def test_results_do_not_depend_on_the_cut(spark, monkeypatch, tokens, slices):
    """Small buckets split frequent contexts by their words."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["a", "b", "c", "d", f"x{i % 7}"], [9, 5, 2, 1, 1], k=12)), 0, i % 4 != 0) for i in range(40)]
    table = spark.createDataFrame(rows, DOC)
    want = {r["doc_id"]: (r["n_tokens"], r["n_known"], round(r["base_score"], 9)) for r in P.score_texts(table, F.col("train")).collect()}
    monkeypatch.setattr(P, "BUCKET_TOKENS", tokens)
    monkeypatch.setattr(P, "LEAST_SLICES", slices)
    got = P.score_texts(table, F.col("train"), block_rows=7).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["n_known"], round(r["base_score"], 9)) for r in got} == want
    _, counts, pairs, chance = fitted(spark, rows)
    for r, (_, t, _, _) in zip(sorted(got, key=lambda r: r["doc_id"]), rows):
        ws = words_of(t)
        assert r["score"] == pytest.approx(sum(math.log10(chance(u, w)) for u, w in zip(["", *ws], ws)), rel=1e-9)


def stirling(c, t, discount):
    """Weight of all ways to seat ``c`` customers at ``t`` tables, by recursion."""
    if c == 0 or t == 0:
        return float(c == t)
    return stirling(c - 1, t - 1, discount) + max(0.0, c - 1 - discount * t) * stirling(c - 1, t, discount)


@pytest.mark.parametrize("count", [2, 5])
def test_seating_follows_its_distribution(count):
    discount, fresh, n = 0.6, 0.7, 200_000
    table = P._log_stirling(P.EXACT, discount)
    got = P.seat(np.full(n, count), np.full(n, fresh), discount, table, np.arange(n, dtype=np.uint64))
    weight = np.array([stirling(count, t, discount) * fresh**t for t in range(1, count + 1)])
    assert np.bincount(got, minlength=count + 1)[1:] / n == pytest.approx(weight / weight.sum(), abs=0.005)


@pytest.mark.parametrize("discount", [0.3, 0.6, 0.9])
@pytest.mark.parametrize("fresh", [0.01, 2.0, 30.0, 100.0])
def test_many_customers_seat_about_as_the_exact_distribution(discount, fresh):
    n, count = 20_000, 200
    got = P.seat(np.full(n, count), np.full(n, fresh), discount, P._log_stirling(P.EXACT, discount), np.arange(n, dtype=np.uint64))
    weight = P._log_stirling(count, discount)[count, 1:] + np.arange(1, count + 1) * math.log(fresh)
    weight = np.exp(weight - weight.max()) / np.exp(weight - weight.max()).sum()
    mean = (weight * np.arange(1, count + 1)).sum()
    spread = math.sqrt((weight * np.arange(1, count + 1) ** 2).sum() - mean**2)
    assert got.mean() == pytest.approx(mean, rel=0.04)
    assert got.std() == pytest.approx(spread, rel=0.15, abs=0.05)
    assert (1 <= got).all() and (got <= count).all()


def test_the_whole_word_before_is_the_context(spark):
    """Words that end alike lead to different words; only the words before tell which."""
    rows = [(i, "red xxing north blue yying south", 0, True) for i in range(40)]
    rows += [(100, "xxing north", 0, False), (101, "yying north", 0, False)]
    got = {r["doc_id"]: r["score"] for r in P.score_texts(spark.createDataFrame(rows, DOC), F.col("train")).collect()}
    assert got[100] > got[101] + 1
