"""Every dealt operator against a brute-force version, on rows with all the odd cases."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from listenlake.llm import (
    exact_dedup, language_id, license_scan, mixing, packing, simhash, sketches, suffix_dedup, toxicity, warc,
)
from listenlake.llm.queries import oracle_sql, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, _doc string"
RNG = np.random.default_rng(3)
WORDS = ["".join(RNG.choice(list("abcdefgäßé"), 5)) for _ in range(300)]


def prose(n: int, seed: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


LONG = prose(5000, 1)
TEXTS = [
    None, "", " \t\n", "123 456", "One two", prose(90, 2), prose(90, 2) + " x", prose(90, 2).replace(" ", "\n"),
    prose(200, 4) + prose(90, 2) + prose(50, 5), LONG, LONG, "a" * 900, "Under the MIT License. under the mit license",
    prose(20, 6), prose(21, 6), "cc-by-nc", prose(300, 8),
]
ROWS = [(i, t, "de" if i % 2 else None, [None, "a", "b"][i % 3], 0, "r", "k", "d") for i, t in enumerate(TEXTS)]
ROWS += [ROWS[5], ROWS[9], (None, "no id", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def squeeze(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_repeats_are_removed_as_by_brute_force(docs):
    found = rows_of(suffix_dedup.remove_repeats(docs).drop("kept"))
    data = [(r[0], (r[1] or "").encode()) for r in ROWS]
    seen = Counter(b[s : s + 400] for _, b in data for s in range(len(b) - 399))
    expected = Counter()
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 399):
            if seen[b[s : s + 400]] > 1:
                gone[s : s + 400] = True
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        expected[i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert found == expected
    # Every anchor counted as a hot one.
    assert rows_of(suffix_dedup.remove_repeats(docs, anchor_contexts=0).drop("kept")) == expected


def test_packing_is_an_exact_round_trip(docs):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(packing.default_tokenizer())
    ids = {r[0]: np.array([*encoder.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in ROWS}
    pieces = packing.pack(docs, packing.default_tokenizer(), group_tails=8).collect()
    total = Counter()
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert (len(part), zlib.crc32(part.tobytes()), p.doc_tokens) == (p.length, p.ids_crc32, len(ids[p.doc_id]))
        total[p.doc_id] += p.length
    assert total == Counter({i: len(ids[i]) * n for i, n in Counter(r[0] for r in ROWS).items()})
    for seq in {p.sequence_id for p in pieces}:
        run = sorted((p.offset, p.length) for p in pieces if p.sequence_id == seq)
        assert [o for o, _ in run] == [sum(n for _, n in run[:i]) for i in range(len(run))]
        assert sum(n for _, n in run) <= packing.CAPACITY


def test_assign_cuts_what_fits_nowhere_and_balances_cost():
    pieces = packing.assign(np.array([3, 3, 3]), capacity=5)
    assert sum(p[2] for p in pieces) == 9 and max(p[4] + p[2] for p in pieces) <= 5
    assert {p[3] for p in packing.assign(np.array([4, 4, 1, 1]), capacity=5)} == {0, 1}


def test_exact_dedup_keeps_longest_then_smallest(docs):
    found = exact_dedup.decisions(docs).collect()
    groups = {}
    for r in ROWS:
        groups.setdefault(squeeze(r[1]), []).append(r)
    best = {t: min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0] for t, g in groups.items()}
    keys = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == Counter(
        (r[0], best[squeeze(r[1])], len(groups[squeeze(r[1])])) for r in ROWS)
    assert Counter(keys[r.text_sha256] for r in found if r.kept) == Counter(dict.fromkeys(groups, 1))
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(best.values())


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints):
    label = {p: p for p in prints}
    for _ in prints:
        for p in prints:
            for q in prints:
                if (p ^ q).bit_count() <= 3:
                    label[p] = label[q] = min(label[p], label[q])
    return label


def test_simhash_matches_brute_force(docs):
    prints = [(r[0], fingerprint(r[1])) for r in ROWS]
    label = brute_components(sorted({p for _, p in prints}))
    first = {}
    for i, p in prints:
        if i is not None:
            first[label[p]] = min(i, first.get(label[p], i))
    assert rows_of(simhash.components(docs)) == Counter((i, f"{p:016x}", first.get(label[p])) for i, p in prints)


@pytest.mark.parametrize("cell", [3, 2000])
def test_grid_finds_every_link_and_splits_hot_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 2**63, 30)]
    prints = set(base)
    for b in base:
        for _ in range(8):
            prints.add(b ^ sum(1 << int(k) for k in rng.choice(63, int(rng.integers(1, 6)), replace=False)))
    label = brute_components(sorted(prints))
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = {r.fp: r.root for r in simhash.contract(simhash.links(fps)).collect()}
    groups = {p: roots.get(p, p) for p in prints}
    assert len(set(groups.values())) == len(set(label.values()))
    assert len({(groups[p], label[p]) for p in prints}) == len(set(label.values()))


def test_mixing_meets_targets_and_repeats(docs):
    found = mixing.plan(docs).collect()
    assert rows_of(mixing.plan(docs)) == Counter(tuple(r) for r in found)
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    weights = dict(zip(["a", "b", None], [5, 2, 1]))
    target, free = {}, dict(weights)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        over = [s for s in free if left * free[s] / sum(free.values()) > 3 * sizes[s]]
        if not over:
            target |= {s: left * w / sum(free.values()) for s, w in free.items()}
            break
        for s in over:
            target[s] = 3 * sizes[s]
            del free[s]
    source = {r[0]: r[3] for r in ROWS}
    taken = Counter()
    for r in found:
        assert r.taken <= 3 * r.size and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len((r.text or "").split())
    assert all(abs(words[s] - target[s]) <= 1 for s in target)


def test_license_scan_matches_brute_force(docs):
    scanner = license_scan.Scanner()
    for text in [r[1] or "" for r in ROWS] + ["apache license version 2 0", "cc by nc by nc cc by nc", "under the mit " * 3]:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        hits = [(i, label) for p, label in license_scan.BASE.items() for i in range(len(words))
                if words[i : i + len(p.split())] == p.split()]
        found = scanner.scan(text)
        assert found[:5] == (len(words), len(hits), min((h[0] for h in hits), default=None),
                             max((h[0] for h in hits), default=None), ",".join(sorted({h[1] for h in hits})))
    for template, label in license_scan.TEMPLATES.items():
        assert label in scanner.scan("x y " + template + " z")[5].split(",")
    assert docs.select(license_scan.scans(docs.source)).count() == len(ROWS)


def test_sketches_and_order(spark, docs):
    from pyspark.sql import functions as F

    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for block in (1, 4, 1000):
        found = {r.doc_id: r for r in sketches.with_next(rows, block).collect()}
        for i, r in found.items():
            assert r.next_text == (TEXTS[(i + 1) % len(TEXTS)] or "")
            assert r.own == sorted(set(r.own)) and r.next == found[(i + 1) % len(TEXTS)].own
    a, b = F.lit("a b c d e f g"), F.lit("a b c d e f h")
    got = spark.range(1).select(
        sketches.resemblance(sketches.sketch(a), sketches.sketch(b)), sketches.distinct_shingles(sketches.sketch(a)),
        sketches.containment(sketches.sketch(a), sketches.sketch(b)), F.size(sketches.sketch(F.lit(" "))),
    ).first()
    assert tuple(got) == (0.5, 3.0, pytest.approx(2 / 3), 0)


def test_warc_round_trip_with_pushed_predicates(spark, empty):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame(
        [(1, "u\n1", "same"), (2, "u2", "same"), (3, "u3", None), (4, "u4", ""), (5, "u5", "é" * 9000), (5, "u5", "é" * 9000), (None, None, "same")],
        "page_id long, url string, html string")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(warc.WarcSource)
    folder, manifest = warc.archive(pages)
    read = spark.read.format("warc").option("manifest", manifest).load(folder)
    b32 = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert rows_of(read.select("page_id", "record_type", "payload_digest", "payload_bytes", "refers_to")) == Counter([
        (1, "revisit", b32("same"), 4, 2), (2, "response", b32("same"), 4, None), (3, "revisit", b32(""), 0, 4),
        (4, "response", b32(""), 0, None), (5, "response", b32("é" * 9000), 18000, None),
        (5, "response", b32("é" * 9000), 18000, None), (None, "revisit", b32("same"), 4, 2)])
    assert read.where("record_type = 'response'").select(F.sum(F.length("payload"))).first()[0] == 36004
    assert read.where("target_uri in ('u4', 'u 1')").count() == 2


def test_language_held_out_accuracy_and_unknown(spark, docs, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    langs = {r.doc_id: r.lang for r in table.select("doc_id", "lang").collect()}
    scored = [r for r in language_id.op10_language_id(spark, sf_dir).collect() if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in scored]) > 0.95
    model = language_id.learn_from(docs)
    assert model.predict(None, {}) == model.predict(" 12 ²", {}) == ("und", 0.0)
    assert language_id.identified(docs).columns == docs.columns


def test_network_gradients_and_toxicity(spark, sf_dir):
    net = toxicity.Network(["a", "b"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = np.random.default_rng(1).normal(size=(2, 5, toxicity.DIM)).astype(np.float32), np.ones((2, 5), np.float32)
    mask[1, 3:] = 0
    tape: dict = {}
    net.forward(x, mask, tape)
    grads, _ = net.backward(tape, np.ones(2))
    for name in ("Wf", "Ub", "att", "v", "out", "cb"):
        spot = (0,) * net.p[name].ndim
        kept, step = net.p[name][spot], 1e-2
        net.p[name][spot] = kept + step
        up = net.forward(x, mask).sum()
        net.p[name][spot] = kept - step
        down = net.forward(x, mask).sum()
        net.p[name][spot] = kept
        assert grads[name][spot] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-3)
    texts = [prose(40, s) + (" badword" if s % 2 else "") for s in range(200)]
    fitted = toxicity.fit(texts, [s % 2 for s in range(200)])
    marks = fitted.scores([prose(60, 900) + " badwords " + prose(60, 901), prose(120, 902), ""], {})
    assert marks[0] >= 0.5 > marks[1] and marks[2] == 0
    assert toxicity.fit(texts, [0] * 200) is None


def test_empty_tables(spark, empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert packing.pack(empty, packing.default_tokenizer()).count() == 0
    assert exact_dedup.deduplicate(empty).count() == exact_dedup.decisions(empty).count() == 0
    assert simhash.components(empty).count() == simhash.representatives(empty).count() == 0
    assert mixing.plan(empty).count() == mixing.mix(empty).count() == 0
    assert sketches.with_next(empty.select("doc_id", "text")).count() == 0
    assert language_id.identified(empty).count() == 0
    assert toxicity.score(empty.select("doc_id", "text"), None).count() == 0


def test_pipeline_stages_chain(spark, docs, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "exact dedup", "SimHash near-dedup", "mixing sources", "packing"]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == docs.columns, name
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries() if name != "pipeline")
    assert set(oracle_sql()) < set(queries()) and numbers == list(range(1, 14)) and "pipeline" in queries()
