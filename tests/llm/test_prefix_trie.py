"""The prefix trie against a dictionary of all prefixes, and the z-fast trie against its definition."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from jobloom.llm import prefix_trie, queries

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "conv_id long, turn long, role string, text string, depth string, sig int"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(rows):
    found = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            found[r[0]].append(((r[1] is not None, r[1] or 0), key, role, text))
    return {c: [(role, text) for *_, role, text in sorted(t)] for c, t in found.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        gain = (len(m) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += gain
    ends = lambda node: hashlib.sha256(",".join(str(c) for c in sorted(members[node]) if len(convs[c]) == len(node)).encode()).hexdigest()
    return Counter((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n], ends(n)) for n, m in members.items())


def got(df):
    assert df.columns == NAMES
    return Counter(map(tuple, df.collect()))


def made(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "d", 1) for r in rows], SCHEMA).repartition(parts)


def random_rows(seed, n=120, alphabet=3, longest=9):
    rng = np.random.default_rng(seed)
    return [(int(c), t, ["user", "assistant", None][int(rng.integers(3))], ["hi  there", "a b\tc", "", None, "x"][int(rng.integers(alphabet))]) for c in rng.permutation(n) - 20 for t in range(int(rng.integers(1, longest)))]


def test_z_fast_trie_by_its_definition():
    rng = np.random.default_rng(1)
    for alphabet, longest in ((2, 40), (3, 6), (1, 300)):
        trie, words, seen = prefix_trie.ZFastTrie(), [], set()
        for i in range(150):
            word = rng.integers(0, alphabet, int(rng.integers(0, longest))).tolist()
            path = b"".join(hashlib.sha256(bytes(word[: d + 1])).digest()[:16] for d in range(len(word)))
            prefixes = {tuple(w[:d]) for w in seen for d in range(len(w) + 1)}
            deepest = max((d for d in range(len(word) + 1) if tuple(word[:d]) in prefixes), default=0)
            before = trie.looked_up
            assert trie.exit_node(path)[1] == deepest
            assert trie.looked_up - before <= 2 * max(1, len(word)).bit_length() + 1
            trie.insert(path, (i, 0))
            words.append(word)
            seen.add(tuple(word))
        prefixes = Counter(tuple(w[:d]) for w in words for d in range(len(w) + 1))
        members, _ = trie.totals()
        assert sum(trie.end[n] - trie.start[n] for n in range(1, len(members))) + 1 == len(prefixes)
        branching = {p for p in prefixes if len({q[len(p)] for q in prefixes if len(q) == len(p) + 1 and q[: len(p)] == p}) != 1 or p in seen}
        assert len(members) == len(branching | {()})
        for node in range(1, len(members)):
            f = prefix_trie.two_fattest(trie.start[node], trie.end[node])
            assert trie.handles[trie._at(trie.path[node], f)] == node
        assert len(trie.handles) == len(members) - 1
    assert [prefix_trie.two_fattest(*x) for x in ((0, 1), (0, 7), (4, 7), (5, 6), (8, 16), (7, 8))] == [1, 4, 6, 6, 16, 8]


def test_random_conversations(spark):
    for seed, alphabet in ((2, 3), (3, 5)):
        rows = random_rows(seed, alphabet=alphabet)
        convs = turns_of(rows)
        df = made(spark, rows)
        assert got(prefix_trie.conversation_trie(df)) == brute(convs)
        cut = prefix_trie.share_heads(prefix_trie.segments(df, 2))
        assert got(prefix_trie.trie_of(cut, batch_turns=40, batch_segments=7, id_text=10)) == brute(rebuilt(convs))


def test_one_long_conversation_beside_short_ones(spark):
    rows = [(40, t, "user", f"turn {t // 2}") for t in range(3000)] + [(41 + c, t, "user", f"turn {t // 2}") for c in range(30) for t in range(c * 5)] + [(41 + c, -1, "user", "turn 0") for c in range(5)]
    df = made(spark, rows)
    convs = turns_of(rows)
    few = {c: t[:] for c, t in convs.items()}
    want = brute({c: t for c, t in few.items() if c != 40} | {40: few[40][:160]})
    found = prefix_trie.segments(df, 64)
    assert found.groupBy("conv").count().where("conv = 40").first()["count"] >= 47
    have = got(prefix_trie.trie_of(found))
    keep = lambda c: Counter({k[:2] + k[2:5]: n for k, n in c.items() if k[1] <= 150})
    assert sum(have.values()) == len({tuple(t[:d]) for t in convs.values() for d in range(len(t) + 1)})
    assert keep(have) == keep(want)
    assert [k for k in have if k[1] == 3000] == [(40, 3000, 40, 1, 0, 1, 0, hashlib.sha256(b"40").hexdigest())]


def test_edges(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "b"), (1, 0, "user", "b"), (None, 1, "user", "lost"), (2, None, "", ""), (3, 1, "user", "w " * 200_000), (4, 1, "user", "w " * 200_000), (60, 0, "a", "b"), (61, 5, "us", "er"), (62, 5, "u", "ser"), (-5, 1, "user", "neg"), (-20, 1, "x", "y")]
    df, convs = made(spark, rows), turns_of(rows)
    assert got(prefix_trie.conversation_trie(df)) == brute(convs)
    assert got(prefix_trie.trie_of(prefix_trie.share_heads(prefix_trie.segments(df)))) == brute(rebuilt(convs))
    assert got(prefix_trie.conversation_trie(df.where("false"))) == Counter()
    assert got(prefix_trie.conversation_trie(df.where("conv_id IS NULL"))) == Counter()
    bare = [(7, 0, "user", "gone"), (8, 0, "user", "gone")]  # turnless: no conversation 0, and none or all of their own turns are past h
    assert got(prefix_trie.trie_of(prefix_trie.share_heads(prefix_trie.segments(made(spark, bare))))) == brute(rebuilt(turns_of(bare)))


def test_registered_query_against_its_sql(spark):
    import duckdb

    for sf in ("sf0.001", "sf0.01"):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '/root/testdata/{sf}/conversations.parquet'")
        want = Counter(con.execute(queries.oracle_sql()["op12_prefix_trie"]).fetchall())
        assert got(queries.op12_prefix_trie(spark, f"/root/testdata/{sf}")) == want
        table = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").collect()
        assert want == brute(rebuilt(turns_of([tuple(r) for r in table])))
