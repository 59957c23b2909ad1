"""Exact copies, the prefix trie and the filter audit against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from qtrbars.llm import exact_copies, filter_audit, prefix_trie
from qtrbars.llm.running import ordered, running

# ------------------------------------------------------------ exact copies


def copy_rows():
    r = random.Random(4)
    texts = ["Same text", "same TEXT", "same text ", "", None, "É", "é", "x" * 50_000, "X" * 50_000, "tab\there", "\x00"]
    rows = [(i, r.choice(texts)) for i in range(200)]
    rows += [(7, "twice"), (7, "twice"), (7, "other"), (None, "no id"), (None, "no id"), (None, "same text"), (900, "Same Text")]
    rows += [(1000 + i, "hot copy") for i in range(300)]
    r.shuffle(rows)
    return rows


def lowered(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.mark.parametrize("digest", [exact_copies.sha256, lambda c: (F.length(c) % 3).cast("string").cast("binary")])
def test_copies(spark, digest):
    rows = copy_rows()
    df = spark.createDataFrame([(i, t, "clash", 1, t) for i, t in rows],
                               "doc_id bigint, text string, digest string, n int, content string").repartition(6)
    found = exact_copies.copies(df, digest=digest, salts=2).collect()
    assert Counter(f["id"] for f in found) == Counter(i for i, _ in rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(-1 if i is None else i)
    want = Counter()
    for members in groups.values():
        keep = max(members)
        for k, i in enumerate(sorted(members, reverse=True)):
            want[(i, keep, len(members), k == 0)] += 1
    assert Counter((-1 if f["id"] is None else f["id"], -1 if f["keep_id"] is None else f["keep_id"],
                    f["group_size"], f["kept"]) for f in found) == want
    kept = exact_copies.deduplicate(df, digest=digest)
    assert kept.columns == df.columns
    assert Counter((k["doc_id"], lowered(k["text"])) for k in kept.collect()) == Counter(
        (None if max(m) == -1 else max(m), t) for t, m in groups.items())


def test_copies_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_copies.copies(empty).count() == 0 and exact_copies.deduplicate(empty).count() == 0


# ------------------------------------------------------------ running sums


def test_running(spark):
    r = random.Random(3)
    rows = [(r.choice([1, 1, 1, 1, 1, 5, 6, -9]), k, r.choice([2 ** 62, -3, 11])) for k in range(4000)]
    df = running(ordered(spark.createDataFrame(rows, "k bigint, o int, v bigint").repartition(5), "k", ["o"]), "k",
                 {"v": ("upto", "before")}, last="end")
    found = df.collect()
    assert len(found) == len(rows) and len({f["__part"] for f in found if f["k"] == 1}) > 2
    total, ends = Counter(), {k: o for k, o, _ in sorted(rows)}
    for f in sorted(found, key=lambda f: (f["k"], f["o"])):
        assert f["before"] % 2 ** 64 == total[f["k"]] % 2 ** 64
        total[f["k"]] += f["v"]
        assert f["upto"] % 2 ** 64 == total[f["k"]] % 2 ** 64
        assert f["end"] == (ends[f["k"]] == f["o"])
    empty = ordered(spark.createDataFrame([], "k bigint, o int, v bigint"), "k", ["o"])
    assert running(empty, "k", {"v": ("a", "b")}).count() == 0


# ------------------------------------------------------------ prefix trie


def conversation_rows():
    r = random.Random(9)
    rows = []
    for c in [*range(0, 40), *range(90, 130), *range(205, 260), -5, -140, 777]:
        n = r.choice([1, 1, 2, 3, 5, 8])
        for t in range(n):  # few texts, so that prefixes are shared
            rows.append((c, t, r.choice(["user", "bot"]), r.choice(["hi", "yes", "é😀", ""])))
    rows += [(c, t, "user", "common") for c in range(600, 660) for t in range(7)]
    rows += [(c, t, "bot", f"long {t}") for c in (3000, 3101) for t in range(400)]  # 3101's head isn't there
    rows += [(4100, None, None, None), (4100, 0, "user", None), (4100, 0, "bot", "tie"), (4100, 0, "bot", "tie"), (4100, -3, None, "x")]
    rows += [(None, 1, "user", "nobody's")]
    r.shuffle(rows)
    return rows


def brute_trie(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in own.items()}
    members, full = defaultdict(list), {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c / 100) * 100
        full[c] = tuple(own.get(base, [])[:h] + v[h:])
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return {(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]) if p in children else 0, leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, sorted(c for c in m if full[c] == p))).encode()).hexdigest())
            for p, m in members.items()}


@pytest.mark.parametrize("bits", [None, 9])
def test_prefix_trie(spark, monkeypatch, bits):
    if bits:  # a sketch so small that many single prefixes are taken for shared ones
        monkeypatch.setattr(prefix_trie, "LEAST_BITS", bits)
        monkeypatch.setattr(prefix_trie, "MOST_BITS", bits)
        monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    rows = conversation_rows()
    df = spark.createDataFrame([(*x, "clash", 5) for x in rows],
                               "conv_id bigint, turn int, role string, text string, d string, n int").repartition(4)
    found = [tuple(x) for x in prefix_trie.trie(df).collect()]
    want = brute_trie(rows)
    assert len(found) == len(want) and set(found) == want


def test_small_tries(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).count() == 0
    # crc32("1") % 6 is over 0, and conversation 0 isn't there: nothing is left
    rows = [(c, 0, "a", "b") for c in (1, 2, 3) if zlib.crc32(str(c).encode()) % 6]
    assert {tuple(x) for x in prefix_trie.trie(spark.createDataFrame(rows, schema)).collect()} == brute_trie(rows)


def test_colliding_digests_are_seen(spark):
    schema = "conv bigint, d bigint, a bigint, b bigint, hi bigint, lo bigint, pa bigint, pb bigint, is_end int"
    same = [(1, 1, 5, 5, 7, 7, 0, 0, 1), (2, 1, 5, 5, 7, 7, 0, 0, 1)]
    assert not prefix_trie.collide(prefix_trie.grouped(spark.createDataFrame(same, schema)))
    assert prefix_trie.collide(prefix_trie.grouped(spark.createDataFrame([*same, (3, 1, 5, 5, 7, 8, 0, 0, 1)], schema)))


# ------------------------------------------------------------ filter audit


def audit_rows():
    r = random.Random(8)
    def text():
        body = " ".join(r.choice(["alpha", "Beta", "γ", "x%y", "WORD"]) + (str(r.randrange(400)) if r.random() < .6 else "")
                        for _ in range(r.choice([0, 5, 199, 200, 260])))
        return r.choice(["", "\n\t"]) + body + r.choice(["", "  ", " "])
    pool = [text() for _ in range(40)] + ["", None, "  ", "A" * 70_000]
    docs = [(i if i % 17 else None, r.choice(pool), r.choice(["s1", "s1", "s1", "s2", None, ""])) for i in range(300)]
    docs += [(5, pool[0], "s2"), (5, pool[0], "s2"), (5, "other", "s1")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(200)] + [(5, 1, 0), (5, 0, 1), (None, 1, 1)]
    return docs, labels


def brute_audit(docs, labels):
    first, good, toxic = {}, set(), set()
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, q, x in labels:
        good |= {i} if q == 1 else set()
        toxic |= {i} if x == 1 else set()
    parts = defaultdict(list)
    for i, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        parts[s or ""].append(({k for k, v in fails.items() if v}, i is not None and i in good, i is not None and i in toxic))
    out = set()
    for part, rows in parts.items():
        shapley = Counter()
        steps = []
        for order in itertools.permutations("ABCDE"):
            left = rows
            for at, name in enumerate(order, 1):
                gone = [x for x in left if name in x[0]]
                left = [x for x in left if name not in x[0]]
                shapley[name] += len(gone)
                steps.append((part, "".join(order), at, len(left), len(gone), sum(name in x[0] for x in rows) - len(gone),
                              sum(x[0] == {name} for x in rows), sum(x[1] for x in gone), sum(x[2] for x in gone), name))
        out |= {(*s[:-1], shapley[s[-1]]) for s in steps}
    return out


def test_filter_audit(spark):
    docs, labels = audit_rows()
    d = spark.createDataFrame([(*x, 1, "clash") for x in docs], "doc_id bigint, text string, source string, mask int, digest string").repartition(5)
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = [tuple(x) for x in filter_audit.audit(filter_audit.mask_counts(d, lab)).collect()]
    want = brute_audit(docs, labels)
    assert len(found) == len(want) == 600 * 3 and set(found) == want
    none = filter_audit.mask_counts(d.where("false"), lab)
    assert filter_audit.audit(none).count() == 0


def test_diagram_keeps_functions_and_shares_nodes():
    counts = {0: (5, 1, 0), 3: (2, 0, 1)}
    diagram = filter_audit.Diagram("ABC", counts)
    assert sum(len(level) for level in diagram.levels) < 7  # shared
    for place in [0, 1, 0, 1, 1]:
        diagram.swap(place)
        node_sum = diagram.weight[diagram.root]
        assert node_sum == (7, 1, 1)
        for mask in range(8):
            node = diagram.root
            for level, name in enumerate(diagram.order):
                node = diagram.levels[level][node][mask >> "ABC".index(name) & 1]
            assert diagram.weight[node] == counts.get(mask, (0, 0, 0))
