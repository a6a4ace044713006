"""Classifiers by held-out accuracy; mixing, archives and the pipeline against plain Python."""

import collections
import hashlib
import math
import random
import zlib

import pytest
from conftest_llm import ODD, prose
from pyspark.sql import functions as F

import corpus_pipeline
from corpusgauge.llm import mixing, neardup, packing, quality_classifier, toxicity, warc

SF = "/root/testdata/sf0.001"

# --- classifiers ----------------------------------------------------------------------------------------


@pytest.fixture
def rude(docs, spark):
    r = random.Random(1)
    pairs, labels = [], []
    for i in range(400):
        parts = [prose(1000 * i + k, 12, 300) + "." for k in range(r.randrange(1, 8))]
        toxic = int(r.random() < 0.3)
        if toxic:
            at = r.randrange(len(parts))
            parts[at] = parts[at].replace(" ", f" vile{r.randrange(50)} ", 1)
        pairs.append((i, " ".join(parts)))
        labels.append((i, 1, toxic, "x"))
    labels += [(None, 1, 1, "x"), (3, 1, None, "x"), (10**6, 1, 1, "x")]
    return docs([*pairs, *ODD]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score string"), dict(pairs)


def test_fit_takes_one_text_of_each_id(docs, spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    pairs = [(7, f"text {k} of one id") for k in range(300)] + [(i, f"text of {i}") for i in range(40) if i != 7]
    take = lambda p: sorted((r.order, r.label, bytes(r.text)) for r in toxicity.sample_of(docs(p), labels, "toxic", 4, 5, 40).collect())
    first = take(pairs)
    assert len(first) == 40 and len({o for o, _, _ in first}) == 40
    assert first == take(pairs[::-1])
    held = take([(i, t) for k in range(3) for i, t in pairs])
    assert first == held


def test_toxicity(rude):
    df, labels, texts = rude
    rows = toxicity.score(df, labels).collect()
    assert len(rows) == 400 + len(ODD)
    truth = {r.doc_id: r.toxic for r in labels.where("toxic is not null").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in texts and r.doc_id in truth]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert len(held) > 60 and sum(r.predicted == truth[r.doc_id] for r in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.score == 0 for r in rows if r.doc_id in (901, 902, 903, 904))
    found = [(r.doc_id, s) for r in rows if r.predicted and r.doc_id in texts for s in r.offending]
    assert found and sum("vile" in s.text for _, s in found) > 0.9 * len(found)
    for i, s in found:
        assert texts[i].encode()[s.start : s.end].decode() == s.text
    assert sum(r.score for r in rows if r.doc_id in texts and not r.held_out) > 0
    left = toxicity.clean(df, labels)
    assert left.columns == df.columns and left.count() == sum(not r.predicted for r in rows)


def test_noisy_or():
    import numpy as np

    known = np.sort(toxicity.Sentences([b"bad worse"]).features[0])
    sentences = [b"bad day. fine day! worse bad\nnothing"]
    first = toxicity._flags((-2.0, known, np.array([1.0, 1.5])))(sentences)
    weight = dict(zip(known.tolist(), (1.0, 1.5), strict=True))
    h = {w: int(toxicity.Sentences([w]).features[0][0]) for w in (b"bad", b"worse")}
    p = lambda *ws: 1 / (1 + np.exp(2.0 - sum(weight[h[w]] for w in ws)))
    assert first[0] == pytest.approx(1 - (1 - p(b"bad")) * (1 - p()) * (1 - p(b"worse", b"bad")) * (1 - p()))


def test_classifiers_without_rows(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score(empty, none).count() == 0 and quality_classifier.score(empty, none).count() == 0
    assert toxicity.score(odd, none).where("score > 0").count() == 0
    assert quality_classifier.score(odd, none).count() == len(ODD)


def test_quality(docs, spark):
    r = random.Random(2)
    pairs, labels = [], []
    for i in range(600):
        good = r.random() < 0.7
        text = prose(i, 60 + r.randrange(100))
        pairs.append((i, text if good else r.choice([text.replace(" ", " $$$ "), text.upper().replace(" ", "!! "), "buy now " * 70])))
        labels.append((i, int(good), 0, "x"))
    labels += [(None, 1, 0, "x"), (5, None, 0, "x")]
    rows = quality_classifier.score(docs([*pairs, *ODD]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score string")).collect()
    truth = {i: q for i, q, *_ in labels[:600]}
    held = [x for x in rows if x.held_out and x.doc_id in truth]
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in rows)
    assert len(rows) == 600 + len(ODD) and sum(x.predicted == truth[x.doc_id] for x in held) > 0.95 * len(held)


def test_features_by_hand():
    texts = ["Ab c!! 12\n", "", "$ ½ é", "  x"]
    got = quality_classifier.features([t.encode() for t in texts])
    for t, row in zip(texts, got, strict=True):
        ws = t.split()
        n, chars = max(len(ws), 1), max(sum(map(len, ws)), 1)
        want = [len(ws), sum(c in "#*$%&|<>" for c in t) / n, t.count("!") / n, sum("A" <= c <= "Z" for c in t) / chars, sum(c in "0123456789" for c in t) / chars, chars / n]
        assert row[:6].tolist() == pytest.approx(want)


# --- mixing -----------------------------------------------------------------------------------------------


def targets_by_hand(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    free, done, rest = set(names), {}, float(sum(sizes.values()))
    while free:
        level = rest / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > most * sizes[s] + 1e-9]
        if not over:
            return done | {s: level * w[s] for s in free}
        for s in over:
            done[s] = most * sizes[s]
            rest -= done[s]
            free.discard(s)
    return done


@pytest.mark.parametrize("seed", range(3))
def test_mix(docs, many_chunks, seed):
    r = random.Random(seed)
    pairs = [(i, prose(i, r.randrange(1, 60))) for i in range(400)]
    source = {i: r.choice([None, "a", "b", "c", "zz", "é", "Z"]) if i % 3 else "hot" for i, _ in pairs} | {901: "empty", 902: "empty"}
    pairs += [(i, t) for i, t in ODD if i != 910]
    df = docs(pairs, lambda i: source.get(i, "odd"))
    rows = mixing.mix(df).collect()
    sizes, got, target, most = collections.Counter(), collections.Counter(), {}, collections.Counter()
    assert len(rows) == len(pairs)
    for x in rows:
        s = x._source
        assert x.taken == x.copies * x["size"] and x.taken <= 3 * x["size"]
        sizes[s] += x["size"]
        got[s] += x.taken
        target[s] = x.target
        most[s] = max(most[s], x["size"])
    assert all(x.source_size == sizes[x._source] for x in rows)
    for s, t in targets_by_hand(sizes).items():
        assert target[s] == pytest.approx(t) and abs(got[s] - t) <= max(1, most[s])
    again = sorted((str(x.doc_id), x["size"], x.taken) for x in mixing.mix(df.repartition(5)).collect())
    assert again == sorted((str(x.doc_id), x["size"], x.taken) for x in rows)
    taken = mixing.taken(df)
    assert taken.columns == df.columns
    want = collections.Counter()
    for x in rows:
        want[str(x.doc_id)] += x.copies
    assert collections.Counter(str(x.doc_id) for x in taken.collect()) == +want


def test_rates_solve_the_dual(docs):
    """Token constraints hold, and log rates are a term of the source and one of the length class, which is what the class misses."""
    r = random.Random(9)
    pairs = [(i, prose(i, r.choice([3, 9, 20, 45, 100, 230]) if i % 4 else 100)) for i in range(500)]
    rows = mixing.mix(docs(pairs, lambda i: "a" if i % 2 else "b" if i % 4 else "c" if i % 8 else "tiny"), weights=(1.0, 4.0, 1.0)).collect()
    tokens, rate, goal = collections.Counter(), {}, {}
    for x in rows:
        at = x._source, x["size"].bit_length()
        tokens[at] += x["size"]
        assert rate.setdefault(at, x.rate) == x.rate and x.rate <= 3
        goal[x._source] = x.target
    for s, t in goal.items():
        assert sum(tokens[k] * rate[k] for k in tokens if k[0] == s) == pytest.approx(t, rel=1e-9)
    bands, whole = {b for _, b in tokens}, sum(tokens.values())
    mu = {}
    for b in bands:
        wanted = sum(n for k, n in tokens.items() if k[1] == b) / whole * sum(goal.values())
        mu[b] = -(sum(n * rate[k] for k, n in tokens.items() if k[1] == b) - wanted) / wanted
    assert max(mu.values()) - min(mu.values()) > 1e-3  # the classes do pull
    for s in goal:
        lam = [math.log(rate[s, b]) - mu[b] for b in bands if (s, b) in rate and rate[s, b] < 3]
        assert max(lam, default=0) - min(lam, default=0) < 1e-6


def test_mix_spreads_equal_rows(many_chunks, docs):
    """A third of the rows are equal, and one id holds another third."""
    pairs = [(7, "same words in all of these")] * 200 + [(8, prose(i, 6)) for i in range(200)] + [(100 + i, prose(1000 + i, 6)) for i in range(200)]
    df = docs(pairs, lambda i: "x" if i < 150 else "y")
    rows = mixing.mix(df).collect()
    for s, t in targets_by_hand(collections.Counter({k: sum(x["size"] for x in rows if x._source == k) for k in "xy"})).items():
        assert abs(sum(x.taken for x in rows if x._source == s) - t) <= 6
    want = collections.Counter()
    for x in rows:
        want[x.doc_id, x._tag] += x.copies
    got = mixing.taken(df).select("doc_id", F.xxhash64("text").alias("t")).groupBy("doc_id", "t").count().collect()
    assert {(x.doc_id, x.t): x["count"] for x in got} == +want


def test_mix_of_nothing(empty):
    assert mixing.mix(empty).count() == 0 and mixing.taken(empty).count() == 0


# --- archives -----------------------------------------------------------------------------------------------


def test_archive_and_audit(spark):
    pages = [(i, f"u{i}", "é" * (i % 50)) for i in range(300)] + [(5000, None, None), (None, "u", "b"), (7, "u7", "é" * 7), (-3, "n", "")]
    schema = "page_id long, url string, html string, file string, digest string"
    frame = lambda rows: spark.createDataFrame([(*x, "c", "c") for x in rows], schema)
    first = warc.archive(frame(pages), per_file=64)
    rows = first.collect()
    assert len(rows) == len(pages)
    by_file = collections.defaultdict(list)
    for r in rows:
        by_file[r.file].append(r)
    for own in by_file.values():
        own.sort(key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
    body = ("é" * 20).encode()
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: u20\r\nContent-Length: 40\r\n\r\n" + body + b"\r\n\r\n"
    one = next(r for r in rows if r.key == 20)
    assert one.digest == hashlib.sha256(record).hexdigest() and one.length == len(record)
    assert warc.audit(first, warc.archive(frame(pages[::-1]), per_file=64)).count() == 0
    # altered, cut off, lost in mid-file and at its end, put in before and between, one of two equal records lost
    bad = [(i, u, "X" + h[1:] if i in (40, 41, 290) and h else h[:3] if i == 130 else h) for i, u, h in pages if i not in (70, 71, 299)]
    bad += [(9000, "new", "x"), (200, "u200", "second of its key"), (20, "u20", "é" * 20)]
    bad.remove((7, "u7", "é" * 7))
    second = warc.archive(frame(bad), per_file=64)
    got = sorted((repr(r.key), r.status, r.start, r.other_start, r.digest, r.other_digest) for r in warc.audit(first, second, fanout=4).collect())
    want = sorted(aligned(rows, second.collect()))
    assert got == want
    seen = collections.Counter(x[1] for x in got)
    assert seen["missing"] == 4 and seen["extra"] == 3 and seen["altered"] == 4 and seen["moved"] > 50
    none = warc.archive(frame([]))
    assert warc.audit(none, none).count() == 0 and warc.audit(first, none).where("status = 'missing'").count() == len(pages)


def aligned(first, second):
    """Records of two archives by key and digest, what is left by key; those at the same offset agree."""
    groups = collections.defaultdict(lambda: ([], []))
    for n, rows in enumerate((first, second)):
        for r in sorted(rows, key=lambda r: (r.file, r.slot)):
            groups[r.file, r.key, r.digest][n].append(r)
    left = collections.defaultdict(lambda: ([], []))
    for (file, key, _), (a, b) in groups.items():
        for x, y in zip(a, b, strict=False):
            if x.start != y.start:
                yield repr(key), "moved", x.start, y.start, x.digest, y.digest
        n = min(len(a), len(b))
        left[file, key][0].extend(a[n:])
        left[file, key][1].extend(b[n:])
    for (_, key), sides in left.items():
        a, b = (sorted(x, key=lambda r: r.slot) for x in sides)
        for i in range(max(len(a), len(b))):
            x, y = (z[i] if i < len(z) else None for z in (a, b))
            status = "extra" if x is None else "missing" if y is None else "altered"
            yield repr(key), status, x and x.start, y and y.start, x and x.digest, y and y.digest


def test_archive_of_one_hot_key(many_chunks):
    rows = [(5, "u", f"b{i % 3}") for i in range(300)] + [(None, "u", "same")] * 300 + [(i, "u", "b") for i in range(300)]
    stored = warc.archive(many_chunks.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for file in {r.file for r in stored}:
        own = sorted((r for r in stored if r.file == file), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert all(x.start + x.length == y.start for x, y in zip(own, own[1:], strict=False))
    assert len(stored) == 900


def test_audit_reads_only_branches_that_differ(spark):
    """The roots of files agree but for one, so only that file's nodes remain below them."""
    pages = spark.range(2000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.col("id").cast("string").alias("html"))
    second = pages.withColumn("html", F.when(F.col("page_id") == 1234, "rot!").otherwise(F.col("html")))
    levels, turn = warc.trees(warc.archive(pages, per_file=100), warc.archive(second, per_file=100))
    differing = [warc._differing(x).count() for x in levels]
    assert differing == [1] * len(levels) and levels[turn].count() == 40 and levels[-1].count() == 2


# --- pipeline ---------------------------------------------------------------------------------------------


def pipeline_folder(spark, tmp_path, rows, labels, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _id string, size string")
    for name, df in (
        ("documents", docs), ("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int")),
        ("benchmark", spark.createDataFrame(items, "item_id long, text string")),
    ):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_pipeline_of_odd_rows(spark, tmp_path):
    """NULLs in any column, empty and long texts, repeated rows and clashing columns: clean documents come through every stage."""
    plain = [(i, prose(7000 + i, 80), "en", "a" if i % 3 else None, 1, "x", "x") for i in range(40)]
    bad = [(100 + i, "vile hateful scum " * 5 + prose(8000 + i, 30), None, "b", None, "x", "x") for i in range(30)]
    copies = [(200, plain[3][1], "en", "a", 1, "x", "x"), plain[4], plain[4]]
    odd = [(i, t, None, None, None, None, None) for i, t in ODD]
    leak = prose(9000, 30)
    rows = plain + bad + copies + odd + [(300, prose(9001, 20) + " " + leak, "en", "a", 1, "x", "x")]
    labels = [(i, 1, 0) for i in range(40)] + [(100 + i, 0, 1) for i in range(30)] + [(None, 1, 0), (5, None, None)]
    folder = pipeline_folder(spark, tmp_path, rows, labels, [(1, leak), (2, None), (3, "")])
    docs, left = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_id", "size"]
        left[name] = collections.Counter(r.doc_id for r in docs.select("doc_id").collect())
    first, near, clean, mixed = left.values()
    assert all(first[i] for i in range(40)) and sum(first[100 + i] for i in range(30)) <= 3
    assert near[3] == 1 and near[200] == 0 and near[4] == 1
    assert clean[300] == 0 and all(clean[i] for i in range(40)) and clean[901] and clean[902]
    assert all(n <= 3 for i, n in mixed.items() if i in range(40))
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_pipeline_of_an_empty_table(spark, tmp_path):
    folder = pipeline_folder(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_stages(spark):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SF).cache()
        kept = {r.doc_id for r in after.select("doc_id").collect()} if n < 4 else None
        came = {r.doc_id: r for r in before.collect()}
        if n < 4:
            assert after.columns == columns and kept <= came.keys()
        if n == 0:
            bad = toxicity.score(before, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1")
            assert came.keys() - kept == {r.doc_id for r in bad.collect()}
        if n == 1:
            from test_near_duplicates import brute

            pairs = [(i, r.text) for i, r in sorted(came.items())]
            assert kept == {i for (i, _), c in zip(pairs, brute(pairs), strict=True) if i == c}
            assert neardup.classes(after).where("not keep").count() == 0
        if n == 2:
            from test_text_operators import hits_by_hand

            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            clean = {w[0] for w in hits_by_hand([(i, r.text) for i, r in came.items()], items) if not w[2]}
            assert {str(i) for i in kept} == clean
        if n == 3:
            goal = {x._source: x.target for x in mixing.mix(before).collect()}
            got = collections.Counter()
            for r in after.collect():
                got[r.source] += len(r.text.split())
                assert r.text == came[r.doc_id].text
            assert all(abs(got[s] - t) <= max(len(r.text.split()) for r in came.values() if r.source == s) for s, t in goal.items())
        if n == 4:
            tokens = after.agg(F.sum("n_tokens")).first()[0]
            assert tokens == packing.pack(before, length=64).agg(F.sum("n_tokens")).first()[0] > 0
        before = after
    spark.catalog.clearCache()
