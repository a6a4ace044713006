"""Repeated passages, contamination, rules, packing and token counts against plain Python."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from conftest_llm import ODD, prose

from corpusgauge.llm import decontaminate, packing, quality_rules, substrings, token_counts
from corpusgauge.llm.tokens import encoder, read_ranks

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACES.split(text or "") if w]


# --- repeated passages -----------------------------------------------------------------------------


def kept_by_hand(pairs, width=13):
    last = max([i for i, _ in pairs if i is not None], default=0) + 1
    own = {}
    for i, t in pairs:
        ws = words(t)
        for k in range(len(ws) - width + 1):
            run = tuple(ws[k : k + width])
            own[run] = min(own.get(run, last), last if i is None else i)
    out = []
    for i, t in pairs:
        ws = words(t)
        gone = set()
        for k in range(len(ws) - width + 1):
            if own[tuple(ws[k : k + width])] < (last if i is None else i):
                gone.update(range(k, k + width))
        left = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((str(i), len(ws), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out)


def kept(df, **settings):
    rows = substrings.remove_repeated(df, **settings).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows)


@pytest.mark.parametrize("sample", [16, 1])
def test_repeated_passages(docs, many_chunks, sample):
    """With every document in the sample, the common passages are hot and go by window."""
    passage, line = prose(1, 60), prose(2, 14)
    pairs = [(i, prose(100 + i, 40) + " " + (passage if i % 2 else line) + "\n" + prose(200 + i, i)) for i in range(40)]
    pairs += [(50, passage + "\t" + passage), (51, " ".join(["again"] * 40)), (52, " ".join(["again"] * 13)), *ODD]
    assert kept(docs(pairs), sample=sample) == kept_by_hand(pairs)


def test_repeated_passages_odd(odd, empty):
    assert kept(odd) == kept_by_hand(ODD)
    assert substrings.remove_repeated(empty).count() == 0


def alternating(n, flip):
    """Two such words (Thue-Morse) collide in every polynomial hash modulo 2**64."""
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


def test_words_that_collide_are_told_apart(docs):
    tail = prose(3, 12)
    pairs = [(1, alternating(1024, 0) + " " + tail), (2, alternating(1024, 1) + " " + tail), (3, alternating(1024, 1) + " " + tail)]
    assert kept(docs(pairs)) == kept_by_hand(pairs)
    assert [n for _, _, n, _ in kept(docs(pairs))] == [0, 0, 13]


def test_windows_of_one_hash_are_told_apart():
    r = random.Random(4)
    codes = np.array([r.randrange(3) for _ in range(400)], np.int32)
    at = np.arange(388)
    rank = np.sort(np.array([r.randrange(9) for _ in at], np.int32))
    weak = np.array([r.randrange(2) for _ in range(3)], np.uint64)[codes[at]]  # only the first word counts
    by, new = substrings._equal_windows(weak, at, codes, 13)
    owner = rank[by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]]
    least = {}
    for k in at:
        window = tuple(codes[k : k + 13])
        least[window] = min(least.get(window, 99), rank[k])
    assert [least[tuple(codes[k : k + 13])] for k in by] == owner.tolist()


def test_repeated_passages_when_one_id_holds_a_third(docs, many_chunks):
    passage = prose(1, 40)
    pairs = [(7, prose(300 + k, 20) + " " + passage) for k in range(40)] + [(7, passage)] * 20
    pairs += [(None, passage + " x")] * 20 + [(100 + k, prose(500 + k, 20) + " " + passage) for k in range(60)]
    assert kept(docs(pairs)) == kept_by_hand(pairs)


# --- benchmark ----------------------------------------------------------------------------------------


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hits_by_hand(pairs, items, width=10):
    runs = collections.defaultdict(set)
    for item, t in items:
        ws = plain(t)
        m = min(len(ws), width)
        for k in range(len(ws) - m + 1 if ws else 0):
            runs[tuple(ws[k : k + m])].add(item)
    out = []
    for i, t in pairs:
        ws, hit, names = plain(t), set(), set()
        for m in {len(r) for r in runs}:
            for k in range(len(ws) - m + 1):
                if tuple(ws[k : k + m]) in runs:
                    hit.update(range(k, k + m))
                    names |= runs[tuple(ws[k : k + m])]
        out.append((str(i), len(ws), len(hit), sorted(n for n in names if n is not None)))
    return sorted(out)


ITEMS = [(1, prose(1, 30)), (2, prose(2, 10)), (3, "Short item of five!"), (4, "zebra"), (5, None), (6, ""), (7, prose(1, 30)[:80]), (None, prose(8, 12)), (2, prose(2, 10))]


def test_contamination(docs, spark):
    r = random.Random(0)
    pairs = [(i, prose(300 + i, r.randrange(60)) + " " + r.choice([x[1] for x in ITEMS if x[1]]).upper() + " " + prose(600 + i, r.randrange(40))) for i in range(50)]
    pairs += [(60, prose(1, 30) + prose(1, 30)), (61, "zebra ZEBRA zebra"), (62, " ".join(plain(prose(1, 30))[3:12])), *ODD]
    df, bench = docs(pairs), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((str(x.doc_id), x.n_words, x.n_hit, sorted(x["items"])) for x in decontaminate.hits(df, bench).collect())
    want = hits_by_hand(pairs, ITEMS)
    assert got == want
    left = decontaminate.clean(df, bench)
    assert left.columns == df.columns and left.count() == sum(x[2] == 0 for x in want)
    spans = decontaminate.clean(df, bench, spans=True)
    assert spans.count() == len(pairs)
    for x in spans.collect():
        before = next(w for w in want if w[0] == str(x.doc_id) and (w[2] or x.text in [t for _, t in pairs])) if x.doc_id not in (None, 907) else None
        if before:
            assert len(plain(x.text)) == before[1] - before[2]


def test_contamination_of_nothing(docs, odd, empty, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.hits(empty, none).count() == 0
    assert decontaminate.hits(odd, none).where("n_hit > 0").count() == 0
    assert decontaminate.clean(odd, none).count() == len(ODD)


# --- rules -------------------------------------------------------------------------------------------


def rules_by_hand(text):
    ws, t = words(text), text or ""
    runs = collections.Counter(tuple(ws[k : k + 3]) for k in range(len(ws) - 2))
    repeated = {k + j for k in range(len(ws) - 2) if runs[tuple(ws[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated)


def test_rules(docs, empty):
    pairs = [(i, t) for i, t in enumerate([prose(1, 80), prose(2, 60, 5), "a b " * 30, prose(3, 70) + "\n" + "x y\n" * 8, prose(4, 55) + " ##$ | <b>"])]
    df = docs([*pairs, *ODD])
    rows = quality_rules.measure(df).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == sorted((str(i), *rules_by_hand(t)) for i, t in [*pairs, *ODD])
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and not r.failed)
    assert quality_rules.measure(empty).count() == 0


def test_rules_run_no_python(docs):
    plan = quality_rules.measure(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- token ids ---------------------------------------------------------------------------------------


def test_packing_gives_texts_back(docs, empty):
    pairs = [*((i, prose(i, 5 + 37 * i)) for i in range(30)), *ODD]
    length, encoding = 128, encoder(read_ranks())
    rows = packing.pack(docs(pairs), length=length).collect()
    parts = collections.defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == length and (ids[r.n_tokens :] == 50256).all() and r.cu_seqlens[-1] == r.n_tokens
        assert r.resets == r.cu_seqlens[:-1]
        at = packing.positions(r.cu_seqlens, length)
        assert [at[x] for x in r.resets] == [0] * len(r.resets)
        for a, b, doc, start in zip(r.cu_seqlens[:-1], r.cu_seqlens[1:], r.doc_ids, r.doc_starts, strict=True):
            parts[doc].append((start, tuple(ids[a:b].tolist())))
    for i, t in pairs:
        if i not in (None, 907) and t:
            ids = [x for _, p in sorted(parts[i]) for x in p]
            assert ids[-1] == 50256 and encoding.decode(ids[:-1]) == t
    assert sum(map(len, parts[907])) and len(parts[907]) == 3 and len(parts[None]) == 1
    assert not {901, 902} & parts.keys()
    assert packing.pack(empty).count() == 0


def test_best_fit_decreasing():
    r = random.Random(3)
    for _ in range(30):
        length = r.choice([7, 64, 100])
        sizes = sorted((r.randrange(1, length + 1) for _ in range(r.randrange(60))), reverse=True)
        free, want = [], []
        for i, n in enumerate(sizes):
            fit = [f for f in free if f >= n]
            at = free.index(min(fit)) if fit else len(free)
            if not fit:
                free.append(length)
                want.append([])
            free[at] -= n
            want[at].append(i)
        got = packing.best_fit_decreasing(sizes, length)
        assert sorted(i for row in got for i in row) == list(range(len(sizes)))
        # rows of one capacity are alike, so the rows' fills agree
        assert sorted(sum(sizes[i] for i in row) for row in got) == sorted(sum(sizes[i] for i in row) for row in want)


def test_written_matrix(docs, spark, tmp_path):
    packed = packing.pack(docs([(i, prose(i, 90)) for i in range(20)]), length=64)
    packing.write(packed, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m")).orderBy("shard", "row").collect()
    assert [(r.ids, r.cu_seqlens, r.resets) for r in back] == [(r.ids, r.cu_seqlens, r.resets) for r in packed.orderBy("shard", "row").collect()]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(docs, empty, rule):
    encoding = encoder(read_ranks())
    pairs = [(1, "a\n\n\nb c\r\nd\n"), (2, "\n"), (3, "Ünï\ncödé ½\n\n x"), (4, prose(1, 50).replace(",", "\n")), *[x for x in ODD if x[0] not in (907, None)]]
    got = collections.defaultdict(list)
    for r in token_counts.by_line(docs(pairs), rule).collect():
        got[r.doc_id].append((r.section, r.start, r.end, r.tokens))
    for i, t in pairs:
        t = t or ""
        lines = re.findall(r"[^\n]*\n|[^\n]+", t) or [""]
        rows = sorted(got[i])
        assert [t[a:b] for _, a, b, _ in rows] == lines
        want, at, line_of = [0.0] * len(lines), 0, [k for k, x in enumerate(lines) for _ in x]
        chars = [k for k, c in enumerate(t) for _ in c.encode()]
        for token in encoding.encode_ordinary(t):
            n = len(encoding.decode_single_token_bytes(token))
            inside = [line_of[c] for c in sorted({chars[b] for b in range(at, at + n)})]
            if rule == "start":
                want[inside[0]] += 1
            elif rule == "end":
                want[inside[-1]] += 1
            elif rule == "most":
                want[max(sorted(set(inside)), key=inside.count)] += 1
            else:
                for x in inside:
                    want[x] += 1 / len(inside)
            at += n
        assert [x for *_, x in rows] == pytest.approx(want)
    assert token_counts.by_line(empty).count() == 0


def test_token_counts_of_fields(docs):
    df = docs([(1, "the text of it"), (2, None), (None, "")])
    rows = sorted(token_counts.by_field(df, ["lang", "text", "source"]).collect(), key=str)
    encoding = encoder(read_ranks())
    total = collections.Counter()
    for r in rows:
        total[r.doc_id] += r.tokens
    assert total == {1: len(encoding.encode_ordinary("en\nthe text of it\ns")), 2: len(encoding.encode_ordinary("en\n\ns")), None: len(encoding.encode_ordinary("en\n\ns"))}
    assert len(rows) == 9
