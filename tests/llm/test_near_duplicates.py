"""Classes of near-duplicates against all pairs compared one by one."""

import collections
import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from conftest_llm import ODD, prose

from corpusgauge.llm import neardup


def words(text):
    return "".join(c.lower() if c.isascii() and c.isalnum() else c if not c.isascii() else " " for c in text or "").split(" ")


def brute(pairs, threshold=0.8, rare=0.01):
    """Class id by position, from all pairs."""
    of = [[w for w in words(t) if w] for _, t in pairs]
    n, df = len(pairs), collections.Counter(w for ws in of for w in set(ws))
    idf = {w: math.log1p(min(n / c, 1 / rare)) for w, c in df.items()}
    bags = []
    for ws in of:
        bag = collections.Counter()
        runs = [tuple(ws)] if 0 < len(ws) < 5 else [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
        for run in runs:
            bag[run] += sum(idf[w] for w in run) / len(run)
        bags.append(bag)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if bags[i] and bags[j]:
                both = sum(min(v, bags[j][k]) for k, v in bags[i].items() if k in bags[j])
                if both / (sum(bags[i].values()) + sum(bags[j].values()) - both) >= threshold:
                    root[find(i)] = find(j)
    ids = [math.inf if i is None else i for i, _ in pairs]
    least = {}
    for i in range(n):
        least[find(i)] = min(least.get(find(i), math.inf), ids[i])
    return [least[find(i)] for i in range(n)]


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(f"new{r.randrange(10**6)}" if r.random() < share else w for w in text.split())


def check(docs, pairs):
    got = [(r.doc_id, r.class_id) for r in neardup.classes(docs(pairs)).collect()]
    want = [(i, None if c == math.inf else c) for (i, _), c in zip(pairs, brute(pairs), strict=True)]
    key = lambda x: (x[0] is None, x)
    assert sorted(got, key=lambda x: str(x)) == sorted(want, key=lambda x: str(x)), key


def test_classes(docs):
    base = [prose(s, 150) for s in range(12)]
    pairs = [(i, t) for i, t in enumerate(base)]
    pairs += [(100 + i, t.upper()) for i, t in enumerate(base[:4])]  # copies but for the case
    pairs += [(200 + i * 10 + k, edited(base[i], k, 0.01 * k)) for i in range(4) for k in range(6)]
    check(docs, pairs)


def test_large_buckets_of_unlike_texts(docs, many_chunks):
    """A passage that fills half of many texts, and a large group that is really alike."""
    passage, core = prose(77, 60), prose(78, 120)
    pairs = [(i, passage + " " + prose(1000 + i, 15 + i % 40)) for i in range(60)]
    pairs += [(500 + i, edited(core, i, 0.012)) for i in range(60)]
    check(docs, pairs)


def drifting(seed, step=2, sizes=(12, 7, 7, 12), n=120):
    """Four families of versions, each like the next one only."""
    r = random.Random(seed)
    text = [f"g{seed}x{i}" for i in range(n)]
    places = list(range(3, n - 6, 6))
    r.shuffle(places)
    out = []
    for k, size in enumerate(sizes):
        for c in range(size):
            own = list(text)
            if size > 8 and c:
                own[r.choice(places)] = f"own{seed}k{k}c{c}"
            out.append(" ".join([*own, f"mark{seed}k{k}c{c}"]))
        for _ in range(step):
            at = places.pop()
            text[at] = f"step{seed}k{k}p{at}"
    return out


def test_members_linked_to_different_leaders_meet(docs, monkeypatch):
    """Chains L1 - X - Y - L2 in one large bucket. The shingles that all of a chain share are looked at first, so
    they all meet in large buckets, where X belongs to the leader L1 and Y to L2."""
    chains = [drifting(s) for s in range(6)]
    pairs = [(100 * s + i, t) for s, texts in enumerate(chains) for i, t in enumerate(texts)]
    hashes = lambda texts: neardup.Shingles([t.encode() for t in texts], 5, ([], [], 1.0)).s
    shared = set()
    for texts in chains:
        shared |= set.intersection(*(set(hashes([texts[k]]).tolist()) for k in (0, 12, 19, 26)))
    late = np.array(sorted(set(hashes([t for _, t in pairs]).tolist()) - shared), np.uint64)
    monkeypatch.setattr(neardup, "_common", lambda *a: (late, np.full(len(late), 1000)))
    monkeypatch.setattr(neardup, "GROWTH", 1)
    got = {r.doc_id: r.class_id for r in neardup.classes(docs(pairs), bands=1, rows=0).collect()}
    assert got == dict(zip([i for i, _ in pairs], brute(pairs), strict=True))
    assert len(set(got.values())) == len(chains)


def test_odd_rows(odd, empty, docs):
    done = neardup.classes(odd)
    assert done.count() == len(ODD)
    of = {(r.doc_id, r._tag): r for r in done.collect()}
    assert all(r.class_id == r.doc_id for r in of.values())
    kept = neardup.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 1  # two rows are equal in id and text
    assert neardup.classes(empty).count() == 0 and neardup.one_of_each(empty).count() == 0
    same = docs([(3, "a b c"), (None, "A, b; c!"), (1, "a b c"), (2, "")])
    assert {r.doc_id: r.class_id for r in neardup.classes(same).collect()} == {3: 1, None: 1, 1: 1, 2: 2}
    assert sorted(r.doc_id for r in neardup.one_of_each(same).collect()) == [1, 2]


def test_samples_agree_as_often_as_texts_are_similar():
    import numpy as np

    none = (np.zeros(0, np.uint64), np.zeros(0, np.float32), 1.0)
    a = prose(1, 400)
    b = a + " " + prose(2, 100)
    x = neardup.Shingles(neardup._plain([a.encode(), b.encode()]), 5, none)
    same = sum(np.equal(*neardup.samples(x, k)) for k in range(1000)) / 1000
    p, q = (dict(zip(x.s[x.first[i] : x.first[i + 1]].tolist(), x.w[x.first[i] : x.first[i + 1]].tolist(), strict=True)) for i in (0, 1))
    both = sum(min(v, q.get(k, 0)) for k, v in p.items())
    assert abs(same - both / (sum(p.values()) + sum(q.values()) - both)) < 0.05


def test_frequencies_hold_little_at_once():
    """Counts are those of whole documents, and memory is that of a piece, not of all texts that are added up."""
    texts = [" ".join(f"w{(i * 7919 + k * k) % 50021}" for k in range(20_000)) for i in range(56)]  # some 7 MB, one sum
    batch = pa.record_batch({"text": pa.array([t.encode() for t in texts])})
    tracemalloc.start()
    got = collections.Counter()
    found = list(neardup._frequencies(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for r in found:
        got.update(dict(zip(r.column("w").to_pylist(), r.column("n").to_pylist(), strict=True)))
    want = collections.Counter(w for t in texts for w in set(t.split()))
    assert sorted(got.values()) == sorted(want.values())
    assert peak < 80 << 20
