"""The prefix trie, fill-in-the-middle and line rules against brute force; edge cases of these and of mended operators."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import fill_middle, hashing, html_text, line_rules, prefix_trie, quality, repeats, substring, toxicity

SF = "/root/testdata/sf0.001"
LONG = "\n".join(f"w{i % 977}x{i % 31} alpha  beta" for i in range(30_000))
ROWS = [(1, "a b\nc"), (2, None), (3, ""), (4, " \t\n"), (None, "x <P> y"), (None, "one two"), (5, LONG), (5, LONG), (6, "\n\n"),
        (7, "no end\nlast line"), (7, "other text of the same id"), (8, "漢字 é\r\nüx\n")]
CLASHING = ("ord", "h", "n", "w", "lines", "pos", "l1", "g", "removed", "kept", "form", "output", "node", "shard", "seq", "turns", "_key")


def rows(df):
    return [tuple(r) for r in df.collect()]


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(*r, "s" if k % 3 else None) for k, r in enumerate(ROWS)], "doc_id long, text string, source string")
    return df.withColumns({c: F.lit("clash") for c in CLASHING}).repartition(3)


# --- balanced parentheses, trie ---------------------------------------------------

def test_findclose_range_min_and_leaves():
    rng = np.random.default_rng(1)
    for n in [1, 2, 3, 40, 700, 5000] * 4:
        steps, opened, closed = [1], 0, 0
        while closed < n:
            up = opened < n and (opened == closed or rng.random() < 0.55)
            steps.append(1 if up else -1)
            opened, closed = opened + up, closed + (not up)
        steps = np.array([*steps, -1])
        tree, stack, pair = prefix_trie.Parentheses(steps), [], {}
        for i, x in enumerate(steps):
            if x == 1:
                stack.append(i)
            else:
                pair[stack.pop()] = i
        opens = np.flatnonzero(steps == 1)
        assert tree.findclose(opens).tolist() == [pair[i] for i in opens]
        values = rng.integers(-99, 99, n + 1)
        lo = rng.integers(0, n + 1, 50)
        hi = np.array([rng.integers(x + 1, n + 2) for x in lo])
        assert prefix_trie.range_min(values, lo, hi).tolist() == [values[a:b].min() for a, b in zip(lo, hi)]


def trie_by_hand(table):
    turns = defaultdict(list)
    for c, t, role, text in table:
        if c is not None:
            role, text = role or "", text or ""
            digest = hexed(f"{len(role)}:{role}{text}")[:32]
            turns[c].append(((t is not None, t or 0), digest, len(re.findall(r"[^\x20\x09-\x0D]+", text)), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, s in own.items():
        base, h = c - int(np.fmod(c, 20)), zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(base, [])[:h] + s[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in built.items():
        ends[tuple(s)].append(c)
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = Counter(k[:-1] for k in members if k)
    saved, leaves = Counter(), Counter()
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * words
            leaves[k[:d]] += kids[k] == 0
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                   hexed(",".join(map(str, sorted(ends[k]))))) for k, m in members.items())


def trie(df, shard_turns=prefix_trie.SHARD_TURNS):
    return sorted(rows(prefix_trie.as_contract(prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.sequences(df)), shard_turns))))


@pytest.mark.parametrize("shard_turns", [1, 5, 1000])
def test_trie_with_nulls_ties_and_copies(spark, shard_turns):
    rnd = random.Random(3)
    ids = [-21, -20, -1, 0, 1, 2, 3, 19, 20, 21, 22, 40, 41, 45, 60, 80, 100, 101, 102, 103, 104, 105, None]
    table = [(rnd.choice(ids), rnd.choice([None, 0, 1, 2, 3, 4]), rnd.choice(["u", "a", None]), rnd.choice(["x y", "z", None, " "])) for _ in range(150)]
    df = spark.createDataFrame(table, "conv_id long, turn int, role string, text string")
    df = df.withColumns({c: F.lit("clash") for c in CLASHING}).repartition(3)
    assert trie(df, shard_turns) == trie_by_hand(table)


def test_trie_with_one_very_common_conversation_over_many_shards(spark):
    table = [(c, t, "u", f"turn {t}" if c % 3 else f"other {c} {t}") for c in range(120) for t in range(3 + c % 2)]
    df = spark.createDataFrame(table, "conv_id long, turn int, role string, text string")
    assert trie(df, 7) == trie_by_hand(table)


def test_trie_of_the_given_tables_and_of_none(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert trie(df) == trie_by_hand(rows(df.select("conv_id", "turn", "role", "text")))
    assert trie(df.limit(0)) == []
    long = spark.range(3000).select(F.lit(5).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    assert len(trie(long)) == 3001 - zlib.crc32(b"5") % 4


# --- fill in the middle -----------------------------------------------------------

def middle_by_hand(doc_id, text, rate=100, spm_rate=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hexed(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, len(lines), "plain", None, None, text
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < spm_rate:
        return doc_id, len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_middle(spark, docs):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    for table, df in ((ROWS, docs), (given, spark.createDataFrame(given, "doc_id long, text string").repartition(2))):
        made = fill_middle.fill_in_middle(df)
        assert sorted(map(str, rows(made))) == sorted(str(middle_by_hand(*r)) for r in table)
        got = {(r["doc_id"], r["output_sha256"]): r["restored_sha256"] for r in fill_middle.as_contract(made).collect()}
        assert got == {(e[0], hexed(e[5])): hexed(r[1] or "") for r, e in ((r, middle_by_hand(*r)) for r in table)}
    assert rows(fill_middle.as_contract(fill_middle.fill_in_middle(docs.limit(0)))) == []


def test_fill_middle_rates(docs):
    made = rows(fill_middle.fill_in_middle(docs, rate=40, spm_rate=0))
    assert sorted(map(str, made)) == sorted(str(middle_by_hand(*r, rate=40, spm_rate=0)) for r in ROWS)
    assert {r[2] for r in made} <= {"plain", "psm"}


def test_chunks_are_shared_checked_and_forgotten():
    data = np.frombuffer(LONG.encode(), np.uint8)
    marks = np.flatnonzero(hashing.Rolling(data).grams(fill_middle.WINDOW) & fill_middle.MASK == 0) + fill_middle.WINDOW
    ends = fill_middle.chunk_ends(marks, 0, len(data))
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and (sizes[:-1] >= fill_middle.LEAST).all() and (sizes <= fill_middle.MOST).all()
    shifted = fill_middle.chunk_ends(np.concatenate([[3], marks + 100]), 0, len(data) + 100)
    assert len(set(np.array(shifted) - 100) & set(ends)) > 0.9 * len(ends)  # an insertion moves few cuts
    cache = fill_middle.Cache(limit=3000)
    a, b = cache.summary(1, b"x\ny\n"), cache.summary(1, b"other\n")  # same hash, other bytes
    assert (a.ends.tolist(), a.points.tolist(), a.chars) == ([2, 4], [2, 4], 4) and b.body == b"other\n"
    assert cache.summary(1, b"x\ny\n") is a and cache.hits == 1
    for k in range(100):
        cache.summary(k + 2, b"z" * 500)
    assert cache.held <= 3000 and len(cache.known) < 5
    assert fill_middle.chunk_ends(np.arange(20_000), 0, 20_000)[:2] == [512, 1024]  # a mark everywhere


# --- line rules -------------------------------------------------------------------

def rules_by_hand(table, max_docs, max_share, min_left=0.5):
    def lines(text):
        return [n for n in (" ".join(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in (text or "").split("\n")) if n]

    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    holders, hosts = defaultdict(set), defaultdict(set)
    for _, text, host in table:
        for x in lines(text):
            holders[host, x.translate(low)].add(text)
            hosts[host].add(text)
    out = []
    for doc_id, text, host in table:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        three = Counter(zip(w, w[1:], w[2:]))
        again = {i + j for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for j in range(3)}
        raw = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        lost = sum(len(x.split(" ")) for x in lines(t)
                   if len(holders[host, x.translate(low)]) > max(max_docs, max_share * len(hosts[host])))
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        out.append((doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(raw) - len(set(raw)), len(again),
                    failed, not failed and not len(w) - lost < min_left * len(w), lost))
    return sorted(map(str, out))


def line_table():
    rnd = random.Random(2)
    shared = [f"Shared   Line {k} of the host" for k in range(6)]
    table = [(k, "\n".join([" ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(40)}" for _ in range(rnd.choice([3, 60]))),
                            *(rnd.choice(shared + [s.lower() for s in shared]) for _ in range(rnd.randrange(14))), "# $ <tag> *"]),
              rnd.choice(["one", "one", "two", None])) for k in range(60)]
    return table + [(k, table[5][1], table[5][2]) for k in range(100, 130)] + [(None, table[6][1], "one")] * 2 + [(200, None, "one"), (201, "", None)]


@pytest.mark.parametrize("heavy", [line_rules.HEAVY, 3])
def test_line_rules(spark, monkeypatch, heavy):
    monkeypatch.setattr(line_rules, "HEAVY", heavy)  # 3: some lines go through the shuffle join
    table = line_table()
    df = spark.createDataFrame(table, "doc_id long, text string, source string").withColumns({c: F.lit("clash") for c in CLASHING}).repartition(4)
    judged = line_rules.judge(df, max_docs=4, max_share=0.1)
    assert sorted(map(str, rows(line_rules.as_contract(judged)))) == rules_by_hand(table, 4, 0.1)
    clean = {r["doc_id"]: r["text"] for r in line_rules.cleaned(df, judged).select("doc_id", "text").collect()}
    kept = [r for r in rows(line_rules.as_contract(judged)) if r[7]]
    assert set(clean) == {r[0] for r in kept} and any("Line" not in x and "line" not in x for x in clean.values())
    for r in kept:
        assert len(clean[r[0]].split()) == r[1] - r[8]


def test_line_rules_edges(spark, docs):
    table = [(*r, "s" if k % 3 else None) for k, r in enumerate(ROWS)]
    assert sorted(map(str, rows(line_rules.as_contract(line_rules.judge(docs))))) == rules_by_hand(table, 10, 0.05)
    assert rows(line_rules.as_contract(line_rules.judge(docs.limit(0)))) == []
    assert len(rows(line_rules.judge(docs.drop("source"), host_col=None))) == len(ROWS)


def test_line_rules_run_without_python_workers(docs):
    plan = line_rules.as_contract(line_rules.judge(docs))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)


# --- mended operators -------------------------------------------------------------

def test_regular_words_of_equal_polynomial_hash_are_told_apart(spark):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    assert hashing.hash_one(word.encode()) == hashing.hash_one(other.encode())  # modulo 2**64
    w = [f"w{i}" for i in range(21)]
    x, y = w[:10] + [word] + w[11:], w[:10] + [other] + w[11:]
    df = spark.createDataFrame([(1, " ".join(x)), (2, " ".join(y)), (3, " ".join(x))], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substring.as_contract(substring.remove_repeats(df)).collect()}
    assert got == {1: 0, 2: 0, 3: 21}


def test_prime_hash_equals_integers():
    data = np.random.default_rng(0).integers(0, 256, (1 << 20) + 500).astype(np.uint8)
    p, roll = int(hashing.P61), hashing.PrimeRolling(data)
    for a, b in ((0, 5), (77, 77), ((1 << 20) - 20, (1 << 20) + 30), (len(data) - 9, len(data))):
        value = sum((int(c) + 1) * pow(hashing._BASE61, i, p) for i, c in enumerate(data[a:b])) % p
        assert int(hashing.mix(np.array([value], np.uint64))[0]) == int(roll.ranges(np.array([a]), np.array([b]))[0])


def test_rows_without_id_go_to_many_routes():
    null = (1 << 63) - 1
    assert len({repeats._document_route(null, h, 16) for h in range(400)}) == 16
    assert len({repeats._document_route(16 * k, 5, 16) for k in range(400)}) == 16


def test_labels_with_long_texts_only(spark):
    long = [(k, " ".join(f"scum{k} idiot{j % 7}" for j in range(1500))) for k in range(12)]
    short = [(k, f"a kind text {k}") for k in range(20, 40)]
    df = spark.createDataFrame(long + short, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k >= 20), int(k < 20)) for k, _ in long + short], "doc_id long, quality int, toxic int")
    for made in (quality.as_contract(df, labels), toxicity.as_contract(df, labels)):
        assert made.count() == 32


def test_pages_of_unclosed_tags_take_linear_time():
    started = time.time()
    for source in ("<p>text</p>" + "<svg>x" * 200_000, "<noscript>a b" * 100_000, "<p><button>" + "<div>" * 40_000 + "x"):
        html_text.extract(source)
    assert time.time() - started < 30
