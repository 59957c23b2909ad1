"""Near copies, repeated substrings and fingerprints against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qtrbars.llm import fingerprints, jaccard, sketch, substring_bytes, substring_words
from qtrbars.llm.components import components
from qtrbars.llm.suffixes import lyndon_groups, suffix_array
from qtrbars.llm.text import Rolling, gram_hash

from . import brute

SCHEMA = "doc_id bigint, text string, row string, spans int, __gone int, component int"


def corpus():
    """Passages, near and exact copies, repeats inside a text, few-word, empty, null and long texts."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 8))) for _ in range(300)]

    def prose(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    line, passage = prose(20), prose(70)
    rows = []
    for i in range(60):
        body = prose(r.randint(5, 150)).split()
        if i % 3 == 0:
            body[len(body) // 2:len(body) // 2] = passage.split()
        text = " ".join(body)
        rows.append(text + ("\n" + line if i % 2 else ""))
    base = prose(120).split()
    for k in range(12):  # a group of near copies, chained
        base = list(base)
        base[r.randrange(len(base))] = f"edit{k}"
        rows.append(" ".join(base))
    rows += [rows[3], rows[3], rows[3].upper(), "a " * 400, "a " * 300, "one two", "ONE  two", "one two three four",
             "", None, " \n\t", prose(6000), "x" * 3000, "x" * 2900, line, line + " and more", "\x00 nul"]
    r.shuffle(rows)
    return [(3 * i + 7, t) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "r", 1, 2, 3) for i, t in rows], SCHEMA).repartition(5)
    return df, rows


def test_suffix_array():
    r = random.Random(2)
    for _ in range(500):
        s = bytes(r.randrange(r.choice([1, 2, 4])) for _ in range(r.randint(0, 40))) * r.choice([1, 1, 3])
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_groups_made_by_the_suffix_sort():
    """The last member of a group takes no new group with it, so few are made that end empty."""
    r = random.Random(9)
    s = bytes(r.randrange(97, 123) for _ in range(4000))
    done, _, group = lyndon_groups(s)
    assert sorted(i for own in done for i in own) == list(range(len(s)))
    assert all(len({group[i] for i in own}) == 1 for own in done)
    assert max(group) + 1 <= 1.1 * len(done)


def test_anchors_of_strings(monkeypatch):
    """They take no prefix sums, and are those of each string alone, wherever it lies."""
    def refused(*_):
        raise AssertionError("prefix sums of a whole slice")
    r = random.Random(10)
    passage = "".join(r.choice("abcdef \u00e9\u4e2d") for _ in range(90))
    texts = ["x" * 30, None, "".join(r.choice("uvw") for _ in range(substring_bytes.STEP - 60)) + passage, "", passage,
             "y" * 49, "z" * 50, passage + passage]
    with monkeypatch.context() as m:
        m.setattr(substring_bytes, "Rolling", refused)
        w = substring_bytes.windows(pa.array(texts))
        head, size = w.contexts()
    raw = [(t or "").encode() for t in texts]
    assert list(zip(w.row.tolist(), w.start.tolist())) == [(k, i) for k, t in enumerate(raw) for i in range(len(t) - 49)]
    alone = [gram_hash(np.frombuffer(raw[k][i:i + 50], np.uint8), 2).min() for k, i in zip(w.row, w.start)]
    assert w.anchor.tolist() == alone
    assert size.sum() == len(w.anchor) and size.max() <= 64
    same = w.identity(np.array([0]), np.array([1]))  # prefix sums are there for those that go on
    assert same == Rolling(np.frombuffer(raw[2], np.uint8), 1).of(np.array([0]), np.array([50]))


def test_powers_of_rolling_hashes():
    data = np.frombuffer(b"abcabcabcd" * 9, np.uint8)
    found = Rolling(data, 7)
    base, value = int(found._powers[7][0][1]), 1
    for there, back in zip(found._powers[7][0][:100].tolist(), found._powers[7][1][:100].tolist()):
        assert there == value and there * back % 2 ** 64 == 1
        value = value * base % 2 ** 64
    assert len(set(found.grams(3).tolist())) == len({bytes(data[i:i + 3]) for i in range(len(data) - 2)})


def test_stretches_and_equal_strings_of_contexts():
    """Contexts under one anchor or several, against a plain look at every string."""
    r = random.Random(11)
    common = [bytes(r.choice(b"abc") for _ in range(r.randint(50, 90))) for _ in range(6)]
    rows = sorted((k % 4, r.randrange(8), (b"" if r.random() < .5 else b"xyz"[:r.randint(1, 3)])
                   + common[k] + r.choice([b"", b"q", b"rs"])) for k in r.choices(range(6), k=60))
    route, doc = (np.array([row[k] for row in rows]) for k in (0, 1))
    size = np.array([len(t) for *_, t in rows])
    bodies, off, n = np.frombuffer(b"".join(t for *_, t in rows), np.uint8), np.cumsum(size) - size, size - 49
    held = {}
    for a, d, t in rows:
        for i in range(len(t) - 49):
            held.setdefault((a, t[i:i + 50]), set()).add(d)
    gone = substring_bytes.same_strings(route.astype(np.uint64), doc, n, bodies, off, size)
    assert gone.tolist() == [d > min(held[a, t[i:i + 50]]) for a, d, t in rows for i in range(len(t) - 49)]
    first, last = substring_bytes._stretches(route.astype(np.uint64), doc, n, bodies, size)
    for (a, _, t), f, e in zip(rows, first.tolist(), last.tolist()):
        at = [i for i in range(len(t) - 49) if len(held[a, t[i:i + 50]]) > 1]
        assert (f, e) == (at[0], at[-1]) if at else e < f


@pytest.mark.parametrize("bits, hot", [(16, 4096), (10, 2)])
def test_words_removed(docs, bits, hot):
    """A sketch far too small, and all anchors dealt window by window, change nothing."""
    df, rows = docs
    found = substring_words.removal(df, cell_bits=bits, hot=hot).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == brute.words_removed(rows)


@pytest.mark.parametrize("bits, hot", [(16, 4096), (10, 2)])
def test_bytes_removed(docs, bits, hot):
    df, rows = docs
    found = substring_bytes.removal(df, cell_bits=bits, hot=hot).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == brute.bytes_removed(rows)


@pytest.mark.parametrize("bits", [16, 10])
def test_jaccard_components(docs, bits):
    df, rows = docs
    found = jaccard.join_components(df, cell_bits=bits).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == brute.jaccard_components(rows)


def test_near_copies_at_many_thresholds(spark):
    """Pairs right at, above and below the threshold, in a dense group."""
    words = [f"w{k}" for k in range(44)]
    rows = []
    for i in range(25):
        t = words[:]
        for k in range(i % 6):
            t[(7 * i + 11 * k) % 44] = f"x{i}.{k}"
        rows.append((100 - i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = jaccard.join_components(df, cell_bits=12).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == brute.jaccard_components(rows)


def test_kept_documents(docs):
    df, rows = docs
    kept = jaccard.keep_one(df, cell_bits=14)
    assert kept.columns == df.columns
    want = {i for i, (_, c) in brute.jaccard_components(rows).items() if c == i}
    assert {r[0] for r in kept.select("doc_id").collect()} == want
    cut = substring_words.deduplicate(df, cell_bits=14)
    assert cut.schema == df.schema or cut.columns == df.columns
    digests = {i: v[2] for i, v in brute.words_removed(rows).items()}
    for r in cut.collect():
        words = brute.WORD.findall(r["text"] or "")
        assert hashlib.sha256(" ".join(words).encode()).hexdigest() == digests[r["doc_id"]]


def test_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e f g h i j k l m n"), (1, "a b c d e f g h i j k l m n")],
                               "doc_id bigint, text string")
    assert sorted((r[0] or 0, r["n_removed"]) for r in substring_words.removal(df, cell_bits=10).collect()) == [(0, 0), (1, 0)]
    assert {r[0]: r["component_id"] for r in jaccard.join_components(df, cell_bits=10).collect()} == {None: None, 1: 1}
    assert jaccard.keep_one(df, cell_bits=10).count() == 2
    none = df.where("false")
    for f in (substring_words.removal, substring_bytes.removal, jaccard.join_components):
        assert f(none, cell_bits=10).count() == 0
    assert fingerprints.with_next(none).count() == 0


def repeated_ids():
    """Rows that share an id, with one text or several, beside rows that don't."""
    r = random.Random(12)

    def prose(n):
        return [f"w{r.randrange(5000)}" for _ in range(n)]
    a, c, shared = prose(40), prose(60), prose(20)
    rows = [(1, a), (1, c), (2, a + ["x"]), (3, c + ["x"]), (1, c), (4, prose(30) + shared), (4, shared + prose(9)),
            (4, []), (5, prose(3) + shared), (5, prose(3) + shared), (6, shared), (6, shared + prose(200)), (7, ["a"]), (7, [])]
    return [(i, " ".join(t)) for i, t in rows]


def test_rows_that_share_an_id(spark):
    """Each row loses what rows with smaller ids have; those with its own id take nothing from it."""
    rows = repeated_ids()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for operator, plain in ((substring_words, brute.words_removed_by_row), (substring_bytes, brute.bytes_removed_by_row)):
        for bits, hot in ((14, 4096), (10, 2)):
            found = operator.removal(df, cell_bits=bits, hot=hot).collect()
            assert sorted(map(tuple, found)) == sorted(plain(rows))
    cut = substring_words.deduplicate(df, cell_bits=12).collect()
    assert sorted((r["doc_id"], len(r["text"].split())) for r in cut) == sorted(
        (i, n - gone) for i, n, gone, _ in brute.words_removed_by_row(rows))
    found = jaccard.join_components(df, cell_bits=12).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(1, 1), (2, 2), (3, 1), (4, 4), (5, 5), (6, 6), (7, 7)}
    assert Counter((r["doc_id"], r["n_shingles"]) for r in found) == Counter(
        (i, len({tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)}) or bool(t)) for i, t in rows)


def thue_morse(n, one, other):
    a, b = one, other
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("n", [10, 12])
def test_words_made_to_collide(spark, n):
    """Words that polynomials modulo 2**64 can't tell apart."""
    a, b = thue_morse(n, "a", "b")
    rest = [f"v{k}" for k in range(12)]
    rows = [(1, " ".join([a] + rest)), (2, " ".join([b] + rest)), (3, " ".join(["x", a, *rest])),
            (4, " ".join([a, "q", "r", "s", "t"])), (5, " ".join([b, "q", "r", "s", "t"]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = substring_words.removal(df, cell_bits=10).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == brute.words_removed(rows)
    assert {r[0]: r["n_removed"] for r in found} == {1: 0, 2: 0, 3: 13, 4: 0, 5: 0}
    linked = jaccard.join_components(df, cell_bits=10).collect()
    assert {r[0]: tuple(r[1:]) for r in linked} == brute.jaccard_components(rows)


def test_common_line_makes_no_pairs(spark):
    """Texts of one common line and a word of their own can't link: their sizes and places say so."""
    line = "one two three four five six seven"
    df = spark.createDataFrame([(i, f"{line} own{i}") for i in range(400)] + [(900, "a b c d e f"), (901, "a b c d e f")],
                               "doc_id bigint, text string")
    posts = jaccard.postings(df.withColumnRenamed("doc_id", "id"), 12).withColumn("doc", F.col("f1")).withColumn("component", F.col("f1"))
    assert posts.groupBy("token").count().agg(F.max("count")).first()[0] == 400
    assert jaccard.cross_pairs(posts.drop("f1", "f2")).count() == 0
    found = jaccard.join_components(df, cell_bits=12).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i for i in range(400)} | {900: 900, 901: 900}


def test_shingles_met_once_are_not_posted(spark):
    """Whatever the first sketch lets through: here every one of its cells is met by many."""
    df = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(300))) for i in range(60)]
                               + [(100 + i, " ".join(f"copy{k}" for k in range(300 - i))) for i in range(2)],
                               "id bigint, text string")
    posts = jaccard.postings(df, 10)
    assert {r["id"] for r in posts.select("id").distinct().collect()} >= {100, 101}
    assert posts.count() < 1000  # of 60 * 75 first shingles and those of the copies


def test_names_met_twice(spark):
    values = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    twice = values[:40]
    df = spark.createDataFrame([(int(v),) for v in values.tolist() + twice.tolist()], "v bigint").repartition(3)

    def hashes(batch):
        yield batch[0].to_numpy().view(np.uint64)

    for bits in (10, 20):
        met = sketch.met(df, hashes, 2, bits)
        assert met.holds(twice).all()
        assert met.holds(values[40:]).mean() < (0.2 if bits == 10 else 0.001)
    assert sketch.met(df, hashes, 1, 20).holds(values).all()


def test_pairs_without_hope(spark):
    """A line of long texts is among their first shingles, but too little of them; those texts aren't fetched."""
    line = " ".join(f"line{k}" for k in range(20))
    rows = [(i, line + " " + " ".join(f"w{i}x{k}" for k in range(100))) for i in range(30)]
    near = " ".join(f"near{k}" for k in range(100))
    rows += [(100, near), (101, near + " more words")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    found = {r["id"] for r in jaccard.maybe_in(df, spark.createDataFrame([(3, 100)], "u bigint, v bigint"), 1, 16).collect()}
    assert found >= {3, 100} and len(found) < 5
    # so few cells that nearly every shingle seems repeated, as in a large input
    posts = jaccard.postings(df, 10).withColumnRenamed("id", "doc").select("token", "doc", "n", "pos")
    pairs = jaccard.star_pairs(posts)
    assert pairs.where("u < 100").count() > 0
    assert [tuple(r) for r in jaccard.hopeful(pairs, jaccard.heads(posts)).collect()] == [(100, 101)]


def test_sets_are_made_of_texts_with_partners_alone(spark, monkeypatch):
    """A line in 30 long texts, and so few cells that nearly every shingle seems repeated, as in a large input."""
    line = " ".join(f"line{k}" for k in range(20))
    rows = [(i, line + " " + " ".join(f"w{i}x{k}" for k in range(100))) for i in range(30)]
    near = " ".join(f"near{k}" for k in range(100))
    rows += [(100, near), (101, near + " more words")]
    tables, plain = {}, jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name: tables.setdefault(name, plain(df, name)))
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"), cell_bits=10)
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(30), 100]
    made = {r["doc"] for name, df in tables.items() if name.endswith("-segments") for r in df.select("doc").distinct().collect()}
    assert made == {100, 101}


def test_sorted_within_rows():
    rng = np.random.default_rng(5)
    for mean in (2, 100):  # both ways of sorting
        row = np.repeat(np.arange(50), rng.integers(0, 2 * mean, 50))
        value = rng.integers(0, 40, len(row)).astype(np.uint64)
        want = value[np.lexsort((value, row))]
        jaccard._sort_within(row, value)
        assert (value == want).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 20)] + [(30, 40), (40, 35), (7, 7), (50, 30)]
    found = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    want = {i: 1 for i in range(1, 21)} | {i: 30 for i in (30, 35, 40, 50)}
    assert {r["node"]: r["component"] for r in found} == want


def followed(spark, rows):
    """(id, n_chars, sha256 of the edited text, fingerprint, its fingerprint) by brute force."""
    marks = {r["t"]: r["m"] for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").select(
        "t", F.xxhash64("t").alias("m")).distinct().collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, marks[x[1]], x[1]), reverse=True)
    want = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        n = len(t) // 2
        edited = t[:len(t) - n] + after[:n]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.fingerprint(t).hex(),
                     fingerprints.fingerprint(edited).hex()))
    return sorted(map(str, want))


def test_fingerprints(spark):
    rows = [(i, t) for i, t in corpus()] + [(None, "last. one\nmore"), (7, "repeated id")]
    found = fingerprints.with_next(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert len(found) == len(rows)
    assert followed(spark, rows) == sorted(str(tuple(r[:5])) for r in found)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    plain = {r[0]: r[1] for r in fingerprints.fingerprints(
        spark.createDataFrame(rows[:20], "doc_id bigint, text string")).collect()}
    assert plain == {i: fingerprints.fingerprint(t).hex() for i, t in rows[:20]}


def test_frequent_ids_have_several_ranges(spark):
    rows = [(None, f"none {k}") for k in range(300)] + [(50, f"same {k}") for k in range(300)] + [
        (k, f"own {k}. And more") for k in range(-100, 200)] + [(50, "same 1"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = fingerprints.with_next(df).collect()
    assert followed(spark, rows) == sorted(str(tuple(r[:5])) for r in found)
    ranges = fingerprints.Ranges.of([1, 5, 5, 5, 9], 2)
    ids, marks = [9, 10, 5, 5, 5, 4, 1, 0, None, None, 6], [0, 0, 2**63 - 1, 0, -2**63, 0, 0, 0, 5 * 10**18, -5 * 10**18, 0]
    import pyarrow as pa
    assert ranges.number(pa.array(ids, pa.int64()), pa.array(marks, pa.int64())).tolist() == [1, 0, 2, 3, 4, 5, 6, 6, 7, 8, 1]


def test_fingerprints_are_homomorphic(spark):
    f = fingerprints.fingerprint
    assert f("one\ntwo\nthree") == f("three\none\ntwo") != f("one\ntwo")
    assert fingerprints.insert(f("one\ntwo"), "three") == f("one\ntwo\nthree")
    assert fingerprints.delete(f("one\ntwo\ntwo"), "two") == f("one\ntwo")
    assert f("one\ntwo\ntwo") != f("one\ntwo") and f("") == f(None) == f("\n\n")
    assert fingerprints.likeness(f("a"), f("a")) == 1 and fingerprints.likeness(f(""), f("a")) == 0
    df = spark.createDataFrame([(1, f("one").hex()), (1, f("two").hex()), (2, f("x").hex())], "g int, fingerprint string")
    found = {r[0]: r[1] for r in fingerprints.sum_fingerprints(df, "g").collect()}
    assert found == {1: f("one\ntwo").hex(), 2: f("x").hex()}


def test_likeness_follows_the_shared_paragraphs():
    r = random.Random(9)

    def text(n):
        return [f"{r.random()} and so on." for _ in range(n)]

    def overlap(a, b):
        one, other = Counter(a), Counter(b)
        return sum((one & other).values()) / sum((one | other).values())

    for n in (6, 20, 60, 150, 400, 3000, 20000):
        for part in (0, 0.1, 0.3, 0.5, 0.9):
            errors = []
            for _ in range(12 if n < 3000 else 4):
                kept = text(round(n * part))
                a, b = kept + text(n - len(kept)), kept + text(n - len(kept))
                repeated = text(1) * r.choice((0, 3, 40))
                a, b = a + repeated, b + repeated[::2]
                got = fingerprints.likeness(fingerprints.fingerprint("\n".join(a)), fingerprints.fingerprint("\n".join(b)))
                errors.append(got - overlap(a, b))
            assert abs(sum(errors)) / len(errors) < 0.08, (n, part, errors)
            assert max(map(abs, errors)) < 0.25, (n, part, errors)
    same = text(5000)
    one, other = (fingerprints.fingerprint("\n".join(x)) for x in (same, same + ["one more"]))
    assert 0.99 < fingerprints.likeness(one, other) < 1


@pytest.mark.parametrize("n", [2 ** 20, 2 ** 21])
def test_counts_of_a_lane_have_no_end(n):
    """A million equal paragraphs and more, by doubling."""
    f, line = fingerprints.fingerprint, "the same line"
    whole = f(line)
    for _ in range(n.bit_length() - 1):
        whole = fingerprints.add(whole, whole)
    less = fingerprints.delete(whole, line)
    assert fingerprints.likeness(less, whole) == pytest.approx((n - 1) / n, abs=1e-9)
    half = f(line)
    for _ in range(n.bit_length() - 2):
        half = fingerprints.add(half, half)
    assert fingerprints.likeness(half, whole) == pytest.approx(0.5)
    assert fingerprints.likeness(whole, f("another")) == 0
    assert f("\n".join([line] * 3000)) == fingerprints.add(f("\n".join([line] * 2000)), f("\n".join([line] * 1000)))


def test_long_fingerprints_are_homomorphic(spark):
    f = fingerprints.fingerprint
    parts = [f"line {i}" for i in range(500)]
    whole, half = f("\n".join(parts)), f("\n".join(parts[:250]))
    assert fingerprints.add(half, f("\n".join(parts[250:]))) == whole
    assert fingerprints.add(whole, f("\n".join(parts[3:])), -1) == f("\n".join(parts[:3]))
    df = spark.createDataFrame([(k % 2, f("\n".join(parts[k::10])).hex()) for k in range(10)] + [(2, f("").hex()), (3, None)],
                               "g int, fingerprint string")
    found = {r[0]: r[1] for r in fingerprints.sum_fingerprints(df.repartition(4), "g").collect()}
    assert found == {0: f("\n".join(parts[::2])).hex(), 1: f("\n".join(parts[1::2])).hex(), 2: f("").hex(), 3: None}
