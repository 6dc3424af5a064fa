"""Rounding of the mix, url classifier against a plain version, near copies that share ids."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from demandlens.llm import mixing, simhash, urls
from demandlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --------------------------------------------------------------------------- 2: mixing

def no_move_improves(rows, cap=2):
    """Per source: the rest, after checking that no cell's move brings it nearer to zero."""
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    rests = {}
    for source, own in by.items():
        rest = own[0].target - sum(r.taken for r in own)
        rests[source] = rest
        near = max(0.5, mixing.NEAR * own[0].target)
        copies, n = Counter(), Counter()
        for r in own:
            assert 0 <= r.copies <= cap and r.taken == r.copies * r.size
            copies[r.size] += r.copies
            n[r.size] += 1
        for size in copies:
            if size and abs(rest) > near:
                for j in range(-copies[size], cap * n[size] - copies[size] + 1):
                    assert abs(rest - j * size) >= abs(rest) - 1e-6, (source, size, j)
    return rests


def _mix(spark, rows):
    return mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()


def test_mix_of_dominated_sources(spark):
    rng = random.Random(5)
    rows = [(i, "a", rng.randint(20, 90)) for i in range(50)] + [(1000, "a", 100_000)]
    rows += [(2000 + i, "b", rng.randint(1, 30)) for i in range(400)] + [(2999, "b", 20_000)]
    rows += [(3000 + i, "c", int(rng.lognormvariate(5, 1)) + 1) for i in range(2500)]
    rows += [(9000, "d", 300), (9001, "d", 301), (9002, None, 7), (9002, None, 7), (None, None, 7)]
    got = _mix(spark, rows)
    assert len(got) == len(rows)
    rests = no_move_improves(got)
    for source in "abc":
        target = next(r.target for r in got if r.source == source)
        assert abs(rests[source]) <= max(1.0, 1e-4 * target), (source, rests[source])
    # a rate below one gives equal documents copies that differ by one at most
    by_size = defaultdict(list)
    for r in got:
        by_size[r.source, r.size].append(r.copies)
    assert all(max(c) - min(c) <= 1 for c in by_size.values())


def test_mix_query_is_where_no_move_improves(spark, docs):
    source = {d["doc_id"]: d["source"] for d in docs}
    df = QUERIES["op2_mixing"](spark, SF)
    names = spark.createDataFrame(list(source.items()), "doc_id long, source string")
    no_move_improves(df.join(names, "doc_id").collect())


def test_mix_many_sources_are_numbered_in_order(spark):
    rng = random.Random(1)
    names = [None, *("".join(rng.choice("aBé\U0001f600z0") for _ in range(6)) for _ in range(300))]
    rows = [(i, s, rng.randint(1, 9)) for i, s in enumerate(names * 2)]
    want = brute.targets([(i, s, "w " * n) for i, s, n in rows])
    for r in _mix(spark, rows):
        assert (r.source_size, r.target) == pytest.approx(want[r.source])


def test_mix_shares_a_large_cell_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART", 50)
    monkeypatch.setattr(mixing, "ROWS", 8)
    rows = [(i, "a", 10) for i in range(1000)] + [(7, "a", 10)] * 60 + [(None, "a", 10)] * 45
    rows += [(5000 + i, "b", 3) for i in range(4000)]
    got = _mix(spark, rows)
    assert len(got) == len(rows) and Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    no_move_improves(got)
    again = _mix(spark, rows[::-1])
    assert Counter((r.doc_id, r.copies) for r in got) == Counter((r.doc_id, r.copies) for r in again)


def test_take_gives_every_row_its_own_copies(spark):
    rows = [(None, "a b c d", "s", "en"), (None, "a b", "s", "en"), (4, "x y z", "s", "en"),
            (4, "x y z", "s", "en"), (4, "x y z", "s", "de"), (5, "", "s", "en"), (6, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = Counter(map(tuple, mixing.take(docs).collect()))
    # one source: 150 % of it, by whole copies of distinct rows
    assert set(got) <= set(rows) and (5, "", "s", "en") not in got
    assert all(n <= 2 * rows.count(r) for r, n in got.items())
    words = sum(len(brute.words(r[1])) * n for r, n in got.items())
    assert abs(words - 1.5 * 15) <= 1
    assert mixing.take(docs.limit(0)).collect() == []


# --------------------------------------------------------------------------- 5: urls

PARTS = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")


def plain_urls(pages):
    """pages: (page_id, url, html) -> {page_id: (rule, verdict)}: Viterbi, then naive Bayes."""
    rows, counts = [], Counter({w: urls.PRIOR_COUNT for w in urls.PRIOR_WORDS})
    for page, url, html in pages:
        host, path, rule, verdict = brute.url_rule(url)
        rows.append((page, host, path, rule, verdict))
        title = re.search(r"(?is)<title>([^<]*)", html or "")
        heard = " ".join(((title[1] if title else "").lower(), path.lower(), host if "-" in host else ""))
        counts.update(w for w in PARTS.findall(heard) if len(w) <= urls.LONGEST and not w.isdigit())
    total = math.log(sum(counts.values()) + 1.0)

    def words(text):
        out = []
        for part in PARTS.findall(text.lower()):
            if not (part.isascii() and part.isalpha()):
                out.append(part)
                continue
            best = [(0.0, 0)]
            for end in range(1, len(part) + 1):
                best.append(min(((best[b][0] + total - (
                    math.log(counts[part[b:end]]) if part[b:end] in counts
                    else -(end - b) * math.log(urls.UNKNOWN_BASE))), b)
                    for b in range(max(0, end - urls.LONGEST), end)))
            cut, end = [], len(part)
            while end:
                cut.append(part[best[end][1]:end])
                end = best[end][1]
            out += cut[::-1]
        return out
    made = [(row, words(row[1]), words(row[2])) for row in rows]
    tokens = [(row, [*own, *("/" + ("0" if re.fullmatch("[0-9]+", w) else w) for w in rest)],
               not urls.SEED_WORDS.isdisjoint(own)) for row, own, rest in made]
    n = {True: Counter(), False: Counter()}
    for _, ts, bad in tokens:
        n[bad].update(ts)
    used = len(n[True] | n[False])
    share = {b: sum(c.values()) + max(used, 1) for b, c in n.items()}
    bad_urls = sum(bad for *_, bad in tokens)
    prior = math.log((bad_urls + 1) / (len(tokens) - bad_urls + 1))
    out = {}
    for (page, host, _, rule, verdict), ts, _ in tokens:
        odds = prior + sum(math.log((n[True][t] + 1) / share[True])
                           - math.log((n[False][t] + 1) / share[False]) for t in ts)
        method = "block" if host and odds > urls.MARGIN else "allow"
        out[page] = (rule, verdict or method, odds)
    return out


def _agree(got, pages):
    want = plain_urls(pages)
    for r in got:
        rule, verdict, odds = want[r.page_id]
        assert r.rule == rule and r.log_odds == pytest.approx(odds, abs=1e-6)
        if abs(odds - urls.MARGIN) > 1e-6:
            assert r.verdict == verdict
    return want


def test_urls_query_against_plain_viterbi_and_bayes(spark, pages):
    rows = [(p["page_id"], p["url"], p["html"]) for p in pages]
    got = urls.judge(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    assert len(got) == len(rows)
    _agree(got, rows)


def test_urls_unseen_hosts_are_told_apart(spark):
    """Hosts without a seed word, but with the words that go with them, are blocked."""
    rng = random.Random(3)
    good = ["garden", "news", "school", "library", "music", "river", "bread", "travel"]
    bad = ["casino", "poker", "jackpot", "slots"]
    mates = ["bonus", "spins", "roulette", "wager"]
    title = "<title>" + " ".join(good + mates) + "</title>"
    train = [(i, f"http://{rng.choice(good)}{rng.choice(good)}.net/{rng.choice(good)}", title)
             for i in range(300)]
    train += [(1000 + i, f"http://{rng.choice(bad)}{rng.choice(mates)}.net/{rng.choice(mates)}", title)
              for i in range(300)]
    held = [(2000 + i, f"http://{a}{b}.net/{c}", title) for i, (a, b, c) in enumerate(
        (a, b, c) for a in mates for b in mates for c in mates)]
    fine = [(3000 + i, f"http://{a}{b}.net/x", title) for i, (a, b) in enumerate(
        (a, b) for a in good for b in good)]
    rows = train + held + fine
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    _agree(got, rows)
    verdict = {r.page_id: r.verdict for r in got}
    caught = sum(verdict[p] == "block" for p, *_ in held) / len(held)
    spared = sum(verdict[p] == "allow" for p, *_ in fine) / len(fine)
    assert caught > 0.9 and spared > 0.95


def test_urls_long_runs(spark):
    run = "".join(random.Random(2).choice("abc") for _ in range(200_000))
    rows = [(1, f"http://{run}.net/{run}", None), (2, "http://x.net/" + "a" * 1_000_000, None),
            (3, "http://x.net/a", None)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted(r.page_id for r in got.select("page_id", "verdict").collect()) == [1, 2, 3]


# --------------------------------------------------------------------------- 9: simhash

def test_keep_one_keeps_one_row_of_every_component(spark):
    a, b = "a b c d e f g h", "x y z w q r s t u v"
    rows = [(7, a), (9, a), (7, b), (8, b), (7, a), (3, ""), (None, "hello"), (None, "hello"),
            (None, b), (None, "m n o p")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, root string")
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()), key=str)
    assert got == sorted([(3, ""), (7, a), (7, b), (None, "hello"), (None, "m n o p")], key=str)
    assert simhash.keep_one(docs).columns == ["doc_id", "text", "root"]
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_passages_oracle_is_the_query(spark):
    import duckdb
    from demandlens.llm.queries import ORACLE_SQL
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.sql(ORACLE_SQL["op7_passages"]).fetchall())
    got = QUERIES["op7_passages"](spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == want
