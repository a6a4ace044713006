"""Prefix trees, periodic runs and chat formatting against plain Python."""

import collections
import hashlib
import random
import zlib

import pytest
from conftest_llm import ODD, prose
from pyspark.sql import functions as F

from corpusgauge.llm import chat, periodic, queries, trie

TURNS = "conv_id long, turn long, role string, text string, id string, key string, pos string, depth string, block string, label string"


@pytest.fixture
def talks(spark):
    return lambda rows: spark.createDataFrame([(*r, *("x",) * 6) for r in rows], TURNS).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows, tie):
    """Turns of each conversation in order, NULL turn first."""
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by[conv].append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    return {c: [(t[3], t[4]) for t in sorted(v)] for c, v in by.items()}


# --- prefix tree -----------------------------------------------------------------------------------


def digest_tie(role, text):
    return sha(sha(role) + sha(text))


def trie_of(convs):
    """Node -> its row, by spelling out every prefix."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, who in members.items():
        under = [m for m in members if m[: len(node)] == node]
        kids = [m for m in members if len(m) == len(node) + 1 and m[:-1] == node]
        leaves = [m for m in under if not any(len(x) == len(m) + 1 and x[:-1] == m for x in members)]
        ends = sorted(c for c in who if len(convs[c]) == len(node))
        out.append((
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids), len(leaves),
            sum((len(members[m]) - 1) * len(m[-1][1]) for m in under if m), sha(",".join(map(str, ends))),
        ))
    return sorted(out, key=str)


def trie_rows(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=str)


def some_talks(seed, n, texts=3, longest=6):
    r = random.Random(seed)
    return [
        (c, t, r.choice(["user", "assistant", None]), r.choice(["", None, *(f"text {k}" for k in range(texts))]))
        for c in range(n) for t in range(r.randrange(1, longest))
    ]


@pytest.mark.parametrize("at_once", [1 << 18, 30])
def test_trie_equals_spelled_out_prefixes(many_chunks, talks, at_once):
    rows = some_talks(1, 60)
    rows += [(5, None, "user", "first by its NULL turn"), (5, None, "user", "first by its NULL turn"), (None, 0, "user", "of no conversation")]
    turns = trie.numbered(talks(rows))
    assert trie_rows(trie.prefix_trie(turns, turns.select("conv_id"), at_once)) == trie_of(ordered(rows, digest_tie))


def test_trie_of_one_long_and_many_equal_conversations(many_chunks, talks):
    rows = [(1, t, "user", f"turn {t % 3}") for t in range(900)]
    rows += [(c, t, "user", f"turn {t}") for c in range(2, 400) for t in range(2)]
    found = trie.numbered(talks(rows))
    got = trie_rows(trie.prefix_trie(found, found.select("conv_id"), at_once=64))
    assert len(got) == 901
    top = next(r for r in got if r[1] == 0)
    assert top[3:6] == (399, 1, 1)
    two = next(r for r in got if r[1] == 2)
    assert two[3] == 399 and two[7] == sha(",".join(map(str, range(2, 400))))
    assert top[6] == 398 * len("turn 0") * 2


def test_splice_takes_first_turns_of_the_hundred(spark, talks):
    rows = [r for r in some_talks(2, 330, longest=9) if r[0] not in (100,)]
    rows += [(-7, 0, "user", "below zero"), (-105, 0, "user", "below")]
    own = ordered(rows, digest_tie)
    want = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (c % 100 if c >= 0 else -(-c % 100))
        want[c] = own.get(head, [])[:h] + turns[h:]
    turns = trie.numbered(talks(rows))
    got = trie_rows(trie.prefix_trie(trie.spliced(turns, 100, 6), turns.select("conv_id")))
    assert any(not w for w in want.values())  # turnless conversations end in the root
    assert got == trie_of(want)


def test_trie_of_nothing(talks):
    turns = trie.numbered(talks([(None, 0, "user", "x")]))
    assert trie.prefix_trie(turns, turns.select("conv_id")).collect() == []


# --- periodic runs -----------------------------------------------------------------------------------


def runs_of(words, length=6, exponent=4):
    out = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(length, exponent * q):
                out.setdefault((i, j - i + q), q)
            i = max(i + 1, j + 1)
    return sorted((i, n, q) for (i, n), q in out.items())


def left_of(words, runs):
    gone = {k for i, n, q in runs for k in range(i + q, i + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def repetitive(seed, n):
    r = random.Random(seed)
    words = []
    while len(words) < n:
        p = r.choice([1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 60])
        block = [f"v{r.randrange(3)}" for _ in range(p)]
        words += (block * 7)[: r.randrange(1, 6 * p + 2)]
    return words


@pytest.mark.parametrize("long, stretch", [(1 << 20, 1 << 14), (1 << 20, 32), (0, 64)])
def test_runs_equal_brute_force(docs, long, stretch):
    pairs = [(i, " ".join(repetitive(i, 40 + 25 * i))) for i in range(25)]
    pairs += [(100, "a " * 500), (101, "a b " * 300), (102, prose(1, 400)), (103, " ".join(["x"] * 49 + ["y"]) * 1 + " ")]
    pairs += [(104, " ".join((["x"] * 49 + ["y"]) * 9))]
    found = {r.doc_id: r for r in periodic.collapse(docs(pairs), long=long, stretch=stretch).collect()}
    assert len(found) == len(pairs)
    for i, text in pairs:
        words = text.split()
        want = runs_of(words)
        assert [tuple(x) for x in found[i].runs] == want, i
        assert found[i].collapsed_text == left_of(words, want)


def test_strongest_run_and_its_ties(docs):
    text = "a a a a a a b c d c d c d c d c d c d e e e e e e"
    row = periodic.collapse(docs([(1, text), (2, "no runs here")])).orderBy("doc_id").collect()
    assert [tuple(r) for r in row[0].runs] == [(0, 6, 1), (7, 12, 2), (19, 6, 1)]
    assert tuple(row[0].strongest) == (0, 6, 1) and row[1].strongest is None


def test_odd_rows_of_runs(odd, empty):
    found = periodic.collapse(odd).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words) for r in found) == sorted(
        (i is None, i or 0, len((t or "").encode().split())) for i, t in ODD
    )
    assert periodic.collapse(empty).collect() == []


def test_one_id_for_a_third_of_rows(docs):
    pairs = [(7, "q r " * 10 + str(k % 3)) for k in range(60)] + [(k, f"s{k} t " * 8) for k in range(100, 220)]
    found = periodic.collapse(docs(pairs)).collect()
    assert len(found) == 180 and all(len(r.runs) == 1 for r in found)


def test_op12_query_equals_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sf).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        words = [w.decode() for w in words]
        want = runs_of(words)
        r = found[doc_id]
        assert r.n_runs == len(want)
        assert r.runs_sha256 == sha("".join(f"{i},{n},{q}\n" for i, n, q in want))
        assert r.collapsed_sha256 == sha(left_of(words, want))
        best = max(want, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if want else (None,) * 3
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)


# --- chat formatting -----------------------------------------------------------------------------------

NASTY = ["\\### Assistant: </turn> ok", "", None, "</turn>", "\\h\\e\\\\", "######", "a: b\nc", "### x</tur</turn>n>", "plain"]


def talk_rows(n=40):
    r = random.Random(5)
    return [(c, t, r.choice(["user", "assistant", "system", None, "a: b\n###"]), r.choice(NASTY)) for c in range(n) for t in range(r.randrange(1, 9))]


def text_tie(role, text):
    return role, text


def digests(convs):
    out = {}
    for c, turns in convs.items():
        said = "".join(t for role, t in turns if role == "assistant")
        out[c] = (len(turns), sha("".join(f"{role}\n{t}\n" for role, t in turns)), len(said), sha(said))
    return out


def read_back(df):
    """Turns, loss text and whole output of each conversation."""
    out = collections.defaultdict(lambda: ([], "", ""))
    for r in df.orderBy("conv_id", "block").collect():
        turns, loss, text = out[r.conv_id]
        assert r.rewritten_at is None and len(r.spans) == r.n_turns
        assert "".join(r.formatted[s.start : s.end] for s in r.spans) == r.formatted
        loss += "".join(chat.PLAIN.unescape(r.formatted[s.text_start : s.text_end]) for s in r.spans if s.role == "assistant")
        out[r.conv_id] = (turns + chat.read_plain(r.formatted), loss, text + r.formatted)
    return out


@pytest.mark.parametrize("settings", [{}, {"block": 3}, {"block": 3, "long": 2, "shares": 1 << 20}])
def test_formatted_text_reads_back(many_chunks, talks, settings):
    rows = talk_rows() + [(99, t % 50 if t % 5 else None, "user", f"t{t}") for t in range(200)]
    want = ordered(rows, text_tie)
    found = read_back(chat.formatted(talks(rows), **settings))
    assert {c: v[0] for c, v in found.items()} == want
    assert all(v[1] == "".join(t for role, t in want[c] if role == "assistant") for c, v in found.items())
    assert all(v[2] == chat.PLAIN.render(want[c]) for c, v in found.items())
    assert all(text.count("</turn>") == len(turns) for turns, _, text in found.values())


def test_op13_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", NASTY[0]), (-7, 1, "assistant", NASTY[0])]
    convs = ordered(rows, text_tie)
    found = {r.conv_id: r for r in queries.op13_chat_formatting(spark, sf).collect()}
    want = digests(convs)
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in found.items()} == want
    assert all(r.formatted_chars == len(chat.PLAIN.render(convs[c])) for c, r in found.items())


def test_template_with_a_look_back(many_chunks, talks):
    def render(turns):
        out, last = "", None
        for role, text in turns:
            out += ("" if role == last else f"[{role}]") + f"<{text}>"
            last = role
        return out

    rows = [(1, t, "user" if t % 7 < 4 else "assistant", f"text {t}") for t in range(50)] + [(2, 0, "user", "x")]
    template = chat.Template(render, lookback=1)
    for settings in ({"block": 4}, {"block": 4, "long": 2, "shares": 1 << 20}):
        text, cut_out = "", []
        for r in chat.formatted(talks(rows), template, **settings).where("conv_id = 1").orderBy("block").collect():
            text += r.formatted
            cut_out += [r.formatted[s.text_start : s.text_end] for s in r.spans]
        assert text == render([(r[2], r[3]) for r in rows if r[0] == 1])
        assert cut_out == [f"text {t}" for t in range(50)]


def test_templates_that_rewrite_history_are_found(talks):
    def forgetful(turns):  # only the last turn keeps its text, as templates do that drop earlier reasoning
        return "".join(f"<{text if i == len(turns) - 1 else '-'}>" for i, (_, text) in enumerate(turns))

    rows = [(1, 0, "user", "one"), (1, 1, "user", "two"), (1, 2, "user", "three"), (2, 0, "user", "-"), (2, 1, "user", "x"), (3, 0, "user", "alone")]
    found = {r.conv_id: r for r in chat.formatted(talks(rows), chat.Template(forgetful, lookback=None)).collect()}
    assert (found[1].rewritten_at, found[1].rewritten_from, len(found[1].spans)) == (1, 1, 1)
    assert found[2].rewritten_at is None and found[3].rewritten_at is None
    assert found[1].formatted == "<-><-><three>"


def test_formatting_nothing(talks):
    assert chat.formatted(talks([(None, 0, "user", "x")])).collect() == []
    assert chat.formatted(talks([(None, 0, "user", "x")]).limit(0)).collect() == []


def test_columns_of_the_queries(spark):
    sf = "/root/testdata/sf0.001"
    assert queries.op11_conversation_trie(spark, sf).select(F.max("depth")).first()[0] > 1
