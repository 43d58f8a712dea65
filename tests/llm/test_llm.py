"""Corpus operators against plain versions, and on odd tables."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.oracle_check import compare, connect
from weirgate.llm import fingerprints, graph, knn, lines, mixing, packing, parity, sharding, suffixes, tokens, toxicity
from weirgate.llm.queries import plans

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, score double, key string"


def words(rng: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls, empty and long texts, copies, near copies, a hot passage, clashing columns."""
    rng = random.Random(5)
    base = words(rng, 120)
    passage = words(rng, 70)
    texts = [None, "", " ", "a", "one two three", "ONE two three", base, base, base + " x", base.upper()]
    texts += [base.replace(f"w{i}", "zz", 1) for i in range(30)]
    texts += [words(rng, 40, 10**6) + "\n" + passage + "\n" + words(rng, 40, 10**6) for _ in range(40)]
    texts += [words(rng, 9000), "é" * 150 + "x" * 150, "ab" * 300, "\x00" * 250]
    rows = [(i * 3 % 211, t, "en", "hot" if i % 3 else None, len(t or ""), 1, 0.5, "k") for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def unlike_ids(spark, rows):
    """Rows with a null id and with a repeated id besides."""
    return spark.createDataFrame([*rows[:8], (None, "lost words here and there and more", "en", "s", 1, 1, 0.1, None), rows[6]], SCHEMA)


@pytest.mark.parametrize("name", sorted(plans.oracles))
def test_matches_sql(spark, name):
    assert compare(spark, connect(SF), SF, plans.queries[name], plans.oracles[name]) is None


def test_repeats_match_brute_force(odd, odd_rows, none, spark):
    wanted = brute.repeats([(r[0], r[1]) for r in odd_rows])
    for row in suffixes.drop_repeats(odd).collect():
        assert tuple(row)[1:] == wanted[row["doc_id"]]
    assert suffixes.drop_repeats(none).count() == 0
    assert suffixes.drop_repeats(unlike_ids(spark, odd_rows)).count() == 10


def test_repeated_rows_take_part_once(spark):
    rng = random.Random(9)
    passage = words(rng, 60, 10**6)
    rows = [(i, words(rng, 40, 10**6) + passage + words(rng, 40, 10**6)) for i in range(4)]
    wanted = brute.repeats(rows)
    df = spark.createDataFrame([*rows, rows[0], rows[2], rows[2], (9, None), (9, None)], "doc_id long, text string")
    found = suffixes.drop_repeats(df).collect()
    assert Counter(r["doc_id"] for r in found) == {0: 2, 1: 1, 2: 3, 3: 1, 9: 2}
    for row in found:
        assert tuple(row)[1:] == (wanted[row["doc_id"]] if row["doc_id"] != 9 else brute.repeats([(9, None)])[9])


def test_repeats_across_split_shards(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(suffixes, "SHARD_STRETCHES", 4)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 2000)
    wanted = brute.repeats([(r[0], r[1]) for r in odd_rows])
    for row in suffixes.drop_repeats(odd).collect():
        assert tuple(row)[1:] == wanted[row["doc_id"]]


def test_anchor_over_several_shards_as_it_stands(spark):
    rng = random.Random(21)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = lambda n: "".join(rng.choices(letters, k=n))
    passage, tails = noise(95), [noise(60) for _ in range(300)]
    rows = [(i, noise(60) + passage + (tails[i % 700] if i % 700 < 300 else noise(60))) for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    raw = df.select(F.col("doc_id").alias("doc"), F.col("text").cast("binary").alias("_w_raw"))
    groups = suffixes.anchors(raw, 100, digests=True).groupBy("hash").agg(F.count_distinct("digest").alias("n"))
    assert groups.agg(F.max("n")).first()[0] > suffixes.SHARD_STRETCHES
    wanted = brute.repeats(rows)
    found = suffixes.drop_repeats(df).collect()
    assert len(found) == len(rows) and sum(r["n_removed"] > 0 for r in found) > 3000
    for row in found:
        assert tuple(row)[1:] == wanted[row["doc_id"]]


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(3)
    parts = [bytes(rng.integers(97, 99, n).astype("uint8")) for n in (40, 1, 130, 130, 64)]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, parts)])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    order, _ = suffixes.suffix_order(data, ends, 130)
    suffix = [bytes(data[i:e]) for i, e in enumerate(ends)]
    assert [suffix[i] for i in order] == sorted(suffix)
    shared = suffixes.common_prefixes(data, offsets[:-1], ends, order, 100)
    for before, here in zip(order, order[1:]):
        n = 0
        while n < min(100, len(suffix[before]), len(suffix[here])) and suffix[before][n] == suffix[here][n]:
            n += 1
        assert shared[here] == n


class Batches:
    """A frame as far as anchors need one: its tasks run here."""

    def __init__(self, texts: list[bytes]) -> None:
        self.batch = pa.record_batch({"doc": list(range(len(texts))), "_w_raw": pa.array(texts, pa.binary())})

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return pa.Table.from_batches(run(iter([self.batch]))).to_pandas()


def test_anchors_hash_short_texts_together(monkeypatch):
    """One call of numpy for many texts, with the stretches each text has alone."""
    rng = random.Random(17)
    texts = [words(rng, rng.randrange(1, 60), 50).encode() for _ in range(400)] + [b"", b"ab" * 300, b"x" * 100]
    assert sum(map(len, texts)) < 1 << 16
    alone = []
    for doc, text in enumerate(texts):
        if len(text) >= 100:
            found = suffixes.anchors(Batches([text]), 100, digests=True)
            alone += [(doc, *row[1:]) for row in found.itertuples(index=False, name=None)]
    calls, hashed = [], suffixes.gram_hashes
    monkeypatch.setattr(suffixes, "gram_hashes", lambda data: calls.append(len(data)) or hashed(data))
    together = suffixes.anchors(Batches(texts), 100, digests=True)
    assert len(calls) == 1
    assert list(together.itertuples(index=False, name=None)) == alone
    halves = suffixes.anchors(Batches(texts), 100, halves=True)["half"]
    assert halves.tolist() == [row[1] >> 32 for row in alone]
    # Of two stretches the digest is the same where their bytes are, wherever they stand.
    bodies = [texts[doc][start : start + windows + 99] for doc, _, start, windows, _ in alone]
    assert len(set(bodies)) == len({(row[4], row[3]) for row in alone}) == len(set(zip(bodies, (row[4] for row in alone))))


def test_equal_suffixes_stand_by_position():
    """Stretches that end alike, or where another goes on, and windows that several hold."""
    rng = np.random.default_rng(8)
    tail = bytes(rng.integers(97, 99, 140).astype("uint8"))
    parts = [b"a" * 60 + tail, b"b" * 9 + tail, tail, tail + b"a", b"a" * 150, b"a" * 143, tail[:7], b"a" * 7]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, parts)])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    order, rank = suffixes.suffix_order(data, ends, 200)
    suffix = [bytes(data[i:e]) for i, e in enumerate(ends)]
    assert order.tolist() == sorted(range(len(data)), key=lambda i: (suffix[i], i))
    assert all((rank[a] == rank[b]) == (suffix[a] == suffix[b]) for a, b in zip(order, order[1:]))
    shared = suffixes.common_prefixes(data, offsets[:-1], ends, order, 100)
    for before, here in zip(order, order[1:]):
        n = 0
        while n < min(100, len(suffix[before]), len(suffix[here])) and suffix[before][n] == suffix[here][n]:
            n += 1
        assert shared[here] == n
    docs, starts = np.array([5, 3, 3, 9, 1, 1]), np.array([0, 0, 500, 0, 400, 0])
    stretch, inside, repeated = suffixes.repeated_windows(parts[:6], docs, starts, 100)
    seen, wanted = set(), set()
    for _, at, s, i in sorted((docs[s], starts[s] + i, s, i) for s in range(6) for i in range(len(parts[s]) - 99)):
        window = parts[s][i : i + 100]
        wanted |= {(s, i)} if window in seen else set()
        seen.add(window)
    assert len(stretch) == sum(len(p) - 99 for p in parts[:6])
    assert set(zip(stretch[repeated].tolist(), inside[repeated].tolist())) == wanted


def test_ngram_join_matches_brute_force(odd, odd_rows, none, spark):
    wanted = brute.similar([(r[0], r[1]) for r in odd_rows])
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity.similar_components(odd).collect()}
    assert found == wanted
    assert parity.similar_components(none).count() == 0
    rows = parity.similar_components(unlike_ids(spark, odd_rows)).collect()
    assert len(rows) == 10
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]


def test_ngram_join_compares_large_groups_in_blocks(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(parity, "SMALL_GROUP", 1)
    monkeypatch.setattr(parity, "SKETCH_BLOCK", 3)
    monkeypatch.setattr(parity, "HUB_ROUNDS", 0)
    wanted = brute.similar([(r[0], r[1]) for r in odd_rows])
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity.similar_components(odd).collect()}
    assert found == wanted


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    none = np.zeros(0, np.uint64)
    for n in [1, 4, 5, 9, 40, 60, 63, 64, 70, 100, 127, 128, 150, 257, 1000]:
        for _ in range(10):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            gone = int(len(a) * rng.uniform(0, 0.2))
            extra = rng.integers(0, 1 << 63, max(0, int(0.2 * len(a)) - gone), dtype=np.uint64)
            b = np.unique(np.concatenate((a[gone:], extra)))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert np.intersect1d(parity.signatures(a, none)[0], parity.signatures(b, none)[0]).size
                apart = np.bitwise_count(parity.bit_sketch(a).view(np.uint64) ^ parity.bit_sketch(b).view(np.uint64)).sum()
                assert apart <= len(a) + len(b) - 2 * both


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 31)} | {i: 100 for i in range(100, 140)}


def test_token_counts_match_library(odd, odd_rows, none):
    found = {r["doc_id"]: r for r in tokens.token_counts(odd, brute.VOCABULARY, keep=["doc_id"]).collect()}
    counts = brute.counts([r[1] or "" for r in odd_rows])
    for row, n in zip(odd_rows, counts):
        assert (found[row[0]]["n_tokens"], found[row[0]]["over_limit"]) == (n, n > 1024)
    assert tokens.token_counts(none, brute.VOCABULARY).count() == 0


def test_token_machines_on_odd_strings():
    rng = random.Random(2)
    bits = ["'", "s", "'s", "'re", "'r", "'ve", "'ll", "'l", " ", "  ", "\n", "\t", "a", "é", "1", "²", "!", "<|endoftext|>", "　", "\x00", "中文", "\x85"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(2000)]
    assert tokens.compiled(brute.VOCABULARY).counts(texts).tolist() == brute.counts(texts)


def test_token_chunks_carry_their_state(monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 128)
    texts = ["don't  we'll\n\n go 12 " * 40, "x" * 300, ""]
    assert tokens.compiled(brute.VOCABULARY).counts(texts).tolist() == brute.counts(texts)


def first_fit(lengths, capacity):
    """Sequences that first fit over falling lengths needs, piece by piece."""
    bins = []
    for n in sorted(lengths, reverse=True):
        at = next((i for i, load in enumerate(bins) if load + n <= capacity), None)
        if at is None:
            bins.append(n)
        else:
            bins[at] += n
    return len(bins)


def test_packing_is_whole_and_tight(odd, odd_rows, none, spark):
    rows = [r.asDict() for r in packing.pack(odd, brute.VOCABULARY).collect()]
    used = brute.check_packing([(r[0], r[1]) for r in odd_rows], rows)
    assert used <= first_fit([r["length"] for r in rows], 1024)
    assert packing.pack(none, brute.VOCABULARY).count() == 0
    repeated = unlike_ids(spark, odd_rows)
    brute.check_packing([(r["doc_id"], r["text"]) for r in repeated.collect()], [r.asDict() for r in packing.pack(repeated, brute.VOCABULARY).collect()])


def test_plan_keeps_counts_and_capacity():
    rng = random.Random(4)
    for _ in range(50):
        counts = Counter(rng.choice([1, 5, 33, 34, 50, 67, 99, 100, rng.randint(1, 100)]) for _ in range(300))
        segments, bins = packing.plan_bins(counts, 100)
        load, seen = Counter(), Counter()
        for length, first, number, base, per_bin, _ in segments:
            assert first == seen[length]
            seen[length] += number
            for i in range(number):
                load[base + i // per_bin] += length
        assert seen == counts and max(load.values()) <= 100 and len(load) == bins
        large = [n for n in counts.elements() if 3 * n > 100]
        assert bins >= -(-sum(counts.elements()) // 100) and bins >= len(large) / 2


def test_shards_are_even_and_whole(odd, odd_rows, none):
    rows = sharding.shard_documents(odd, 7).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    wanted = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == wanted
    assert sharding.shard_documents(none, 7).count() == 0


def test_communication_matrix_is_exact():
    matrix = sharding.communication_matrix([50, 0, 7, 43], [34, 33, 33], 1)
    assert matrix.sum(axis=1).tolist() == [50, 0, 7, 43] and matrix.sum(axis=0).tolist() == [34, 33, 33]
    rng = np.random.default_rng(0)
    draws = [sharding.hypergeometric(2 * 10**9, 2 * 10**9, 1000, rng) for _ in range(300)]
    assert abs(np.mean(draws) - 500) < 5 and 12 < np.std(draws) < 20


def test_mixing_follows_weights(spark, none):
    df = spark.createDataFrame([(i, "t", "a" if i % 10 else None) for i in range(4000)], "doc_id long, text string, source string")
    mixed = Counter(r["source"] for r in mixing.mix(df, weights={"a": 1.0}, total=300_000).collect())
    assert set(mixed) == {"a"} and abs(mixed["a"] - 300_000) < 4 * 300_000**0.5
    again = [mixing.mix(df, temperature=0.5).select("doc_id", "copy").collect() for _ in range(2)]
    assert sorted(again[0]) == sorted(again[1])
    assert mixing.mix(none).count() == 0


def test_lines_of_a_site(spark, none):
    rows = [(i, f"menu\nown {i}\n\nmenu", "h", 9) for i in range(20)] + [(99, None, None, 1), (98, "menu", "other", 1)]
    df = spark.createDataFrame(rows, "page long, body string, site string, n_lines long")
    found = {r["page"]: r for r in lines.line_dedup(df, "body", "site").collect()}
    assert found[3]["body"] == "own 3\n" and found[3]["n_dropped"] == 2 and found[3]["n_lines"] == 4
    assert found[98]["body"] == "menu" and found[99]["body"] == "" and len(found) == 22
    assert lines.line_dedup(none, "text", "source").count() == 0


def test_lines_of_small_hosts(spark):
    # One page, two, 9, and 60 with lines on 2, 3 and 4 of them.
    rows = [("one", "menu\nmenu\nown")]
    rows += [("two", f"menu\nown {i}") for i in range(2)]
    rows += [("nine", f"menu\nown {i}" + ("\nrare" if i < 2 else "")) for i in range(9)]
    rows += [("sixty", "\n".join([f"own {i}", *[f"on {n}" for n in (2, 3, 4) if i < n]])) for i in range(60)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page long, site string, body string")
    found = {r["page"]: r["body"] for r in lines.line_dedup(df, "body", "site").collect()}
    for page, (site, body) in enumerate(rows):
        pages = [set(b.split("\n")) for s, b in rows if s == site]
        kept = [x for x in body.split("\n") if not (n := sum(x in p for p in pages)) > max(1, 0.05 * len(pages))]
        assert found[page] == "\n".join(kept)
    assert found[0] == "menu\nmenu\nown" and found[1] == "own 0" and found[12] == "own 0\non 2\non 3"


def test_lines_by_salted_join(spark, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(i, f"menu\n{i}", "h") for i in range(20)], "page long, body string, site string")
    assert {r["body"] for r in lines.line_dedup(df, "body", "site").collect()} == {str(i) for i in range(20)}


def test_top_scores_match_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], 0) for i in range(300)]
    rows += [(400 + i, rows[0][1], 0) for i in range(40)]
    rows += [(500, None, 0), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (600, [float("nan")] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = sorted(tuple(r)[:4] for r in knn.top_k(df).select("query_id", "rank", "vec_id", "score").collect())
    assert found == brute.best_scores(exact)
    assert knn.top_k(df.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in knn.top_k(few).collect()] == [(0, 1, 1, 256 * 512)]


def test_top_scores_bound_the_queries_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(knn, "QUERY_ROWS", 40, raising=False)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 100)
    solve, most = knn._solve, 80

    def checked(k):
        run = solve(k)

        def bounded(queries, data):
            assert len(queries) <= most, f"{len(queries)} queries in one task"
            return run(queries, data)

        return bounded

    monkeypatch.setattr(knn, "_solve", checked)
    rng = random.Random(3)
    rows = [(i, [1.0, 0.5]) for i in range(250)] + [(i, [rng.uniform(-1, 1), rng.uniform(-1, 1)]) for i in range(250, 600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(tuple(r) for r in knn.top_k(df, query_step=1).select("query_id", "rank", "vec_id", "score").collect())
    assert found == brute.best_scores([(r["vec_id"], r["embedding"]) for r in df.collect()], step=1)


def test_fingerprints(odd, odd_rows, none, spark):
    rows = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(odd).collect()}
    texts = {r[0]: r[1] or "" for r in odd_rows}
    ids = sorted(texts, reverse=True)
    import hashlib

    for i, d in enumerate(ids):
        text, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        tail = len(text) // 3
        edited = text[: len(text) - tail] + after[:tail]
        assert rows[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[d]["n_chars"] == len(text)
        assert 0 <= rows[d]["near_edited"] <= 1 and 0 <= rows[d]["near_next"] <= 1
    for a in ids:
        for b in ids:
            if texts[a] == texts[b]:
                assert rows[a]["fingerprint"] == rows[b]["fingerprint"]
    assert fingerprints.edited_fingerprints(none).count() == 0
    assert fingerprints.edited_fingerprints(unlike_ids(spark, odd_rows)).count() == 10


def test_edits_stay_nearer_than_strangers(spark):
    rows = plans.queries["op1_fingerprints"](spark, SF).collect()
    nearer = sum(r["near_edited"] > r["near_next"] for r in rows)
    assert nearer > 0.85 * len(rows)


def test_toxicity_learns_held_out_rows(spark, none):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 7 == 0
        text = words(rng, 30) + (f" you {rng.choice(['vilo', 'grumpf'])}{rng.choice(['', 's', 'en'])}. " if toxic else ". ") + words(rng, 10)
        rows.append((i, text))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "vilo")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    grammar = toxicity.fit(df, known)
    scored = toxicity.score(df.withColumn("score", toxicity.held_out("doc_id")), grammar, keep=["doc_id"]).collect()
    wanted = dict(labels)
    assert len(scored) == len(rows)
    wrong = [r["doc_id"] for r in scored if r["doc_id"] in wanted and r["predicted"] != wanted[r["doc_id"]]]
    assert len(wrong) <= 6
    assert all(r["predicted"] == 0 for r in scored if r["doc_id"] in (1000, 1001))
    assert toxicity.score(none, toxicity.fit(none, known)).count() == 0


def test_grammar_tells_clauses_apart():
    matcher = toxicity.Grammar({"idiot": 2.0, "vil*": 1.0}).matcher()
    plain, targeted, negated, reported, threat, at_target = range(6)

    def kinds(text):
        return set(np.flatnonzero(matcher.features(text)).tolist())

    assert kinds("What an idiot. You sleep.") == {plain}
    assert kinds("You are an idiot") == {targeted} and kinds("vilest one of you") == {targeted}
    assert kinds("not an idiot") == {negated}
    assert kinds("they said idiot") == {reported}
    assert kinds("I will kill you") == {at_target} and kinds("kill it") == {threat}
    assert kinds("idiotic devil") == set()


def test_pipeline_stages_match_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        after = stage(spark, docs, SF)
        rows = [r.asDict() for r in after.collect()]
        if name != "packing":
            assert after.columns == docs.columns
        if name == "toxicity":
            assert {r["doc_id"] for r in rows} < {r["doc_id"] for r in before} and len(rows) > 0.8 * len(before)
        elif name == "line_dedup":
            assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in before)
        elif name == "ngram_join":
            wanted = brute.similar([(r["doc_id"], r["text"]) for r in before])
            assert {r["doc_id"] for r in rows} == {c for _, c in wanted.values()}
        elif name == "mixing":
            assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in before}
            assert max(Counter(r["doc_id"] for r in rows).values()) > 1
        else:
            brute.check_packing([(r["doc_id"], r["text"]) for r in before], rows)
        docs = spark.createDataFrame(rows, after.schema)


def test_pipeline_stages_take_odd_tables(spark, odd, none):
    for _, stage in corpus_pipeline.STAGES:
        base = odd.select("doc_id", "text", "lang", "source", "n_chars")
        assert stage(spark, base, SF).count() > 0
        assert stage(spark, none.select(*base.columns), SF).count() == 0


def test_pipeline_stages_leave_columns_alone(spark, odd):
    names = ["score", "predicted", "n_lines", "n_dropped", "copy", "rate", "component_id", "n_shingles", "_w_text"]
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(f"own {n}").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        rows = after.collect()
        assert rows and all(r[n] == f"own {n}" for r in rows for n in names), name


def test_one_row_of_a_group_stays(spark):
    rng = random.Random(8)
    text, near, other, lost = words(rng, 100), None, words(rng, 80, 10**6), words(rng, 60, 10**6)
    near = text + " w1"
    rows = [
        (5, text), (5, text), (5, near), (7, text), (None, text), (None, lost), (None, lost + " z"), (None, lost),
        (8, other), (9, ""), (9, ""), (None, None), (10, "one two"), (11, "ONE  two"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    smallest = min((text, near), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert Counter(k for k in kept if k[0] is not None) == Counter(
        [(5, smallest), (8, other), (9, ""), (9, ""), (10, "one two")]
    )
    nameless = [t for i, t in kept if i is None]
    assert len(nameless) == 2 and None in nameless and any(t and t.startswith(lost) for t in nameless)


def test_whole_pipeline_keeps_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    rows = [r.asDict() for r in corpus_pipeline.run(spark, SF).collect()]
    brute.check_packing([(r["doc_id"], r["text"]) for r in docs.collect()], rows)
