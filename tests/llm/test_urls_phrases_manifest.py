"""URL filter, collocations and Merkle manifest against plain versions."""

import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import awkward, documents, grouped, lowered, prose
from tests.oracle import compare, connect
from tidemark.llm import collocations, merkle, queries, sql, url_filter

# ---- URL filter

RULES = [*queries.URL_RULES, ("a.b", "/x", "block"), ("b", "/x/y", "allow"), ("b", "", "allow"),
         ("tie.org", "/", "allow"), ("tie.org", "/", "block"), ("TIE.org", "/Up", "block"),
         ("bad/host", "/", "block"), ("com", "no-slash", "block"), ("", "/", "block"),
         (None, "/", "block"), ("com", None, "block")]
URLS = [None, "", "no scheme", "http://", "http://example.com", "http://example.com/",
        "HTTP://WWW.Example.COM/en/1?q=1#f", "http://example.com/en", "http://example.com/en/",
        "x://notexample.com/en/", "http://example.com:80/en/", "http://u@example.com/en/",
        "http://a.b.net/es/x", "http://net/es/", "http://anet/es/", "http://a.b/x/y",
        "http://c.a.b/x/y", "http://b/x/y", "http://b?x", "http://tie.org/Upper",
        "http://tie.org/up", "http://a..com/", "http://.com/", "http://com./", "//x.com/",
        "q?://x.com/a", "http://x.com\n/a\nb", "http://é.com/é?", "a://b://c.com/",
        "http://" + "l." * 3000 + "net/fr/" + "p" * 50_000]


def plain_judged(urls, rules, default="allow"):
    out = []
    for page, url in urls:
        rest = (url or "").partition("://")[2]
        host = lowered(re.match(r"[^/?#]*", rest).group())
        path = re.match(r"[^?#]*", rest[len(re.match(r"[^/?#]*", rest).group()):]).group()
        fits = [(len(h) + len(p), len(h), v, lowered(h) + p) for h, p, v in rules
                if h and p is not None and "/" not in h
                and (host == lowered(h) or host.endswith("." + lowered(h)))
                and path.startswith(p) and (p == "" or p[0] == "/")]
        best = max(fits, default=(0, 0, default, None))
        out.append((page, host, path, best[3], best[2]))
    return grouped(out)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "x", 1, 2, "h") for i, u in rows],
                                 "page_id long, url string, html string, times int, task int, "
                                 "host string")


def rule_rows(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def judged(df):
    return grouped(df.select("row.page_id", "host", "path", "rule", "verdict").collect())


def test_urls_awkward(spark):
    rows = [*enumerate(URLS), (None, URLS[6]), (3, URLS[3]), (3, URLS[3])]
    rules = [r for r in RULES]
    got = judged(url_filter.judge(pages(spark, rows), rule_rows(spark, rules), ["page_id"]))
    assert got == plain_judged(rows, rules)
    verdicts = {page: (rule, verdict) for page, _, _, rule, verdict in got}
    assert verdicts[URLS.index("http://tie.org/up")] == ("tie.org/", "block")
    assert verdicts[URLS.index("http://example.com")] == (None, "allow")


def test_urls_random(spark):
    rng = random.Random(5)
    hosts = [".".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(300)]
    paths = ["/" + "".join(rng.choices("xy/", k=rng.randint(0, 5))) for _ in range(300)]
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in zip(hosts[:80], paths)]
    rows = [(k, f"s://{h}{p}?{k}") for k, (h, p) in enumerate(zip(hosts, reversed(paths)))]
    rows += [(k, rows[0][1]) for k in range(400, 700)]  # one URL very often
    got = judged(url_filter.judge(pages(spark, rows), rule_rows(spark, rules), ["page_id"],
                                  default="block"))
    assert got == plain_judged(rows, rules, "block")


def test_urls_empty(spark):
    rules = rule_rows(spark, RULES)
    assert judged(url_filter.judge(pages(spark, []), rules, ["page_id"])) == []
    got = judged(url_filter.judge(pages(spark, [(1, "a://b/c")]), rules.limit(0), ["page_id"]))
    assert got == [(1, "b", "/c", None, "allow")]


def test_urls_native(spark):
    plan = url_filter.judge(pages(spark, [(1, "a://b/c")]).select("page_id", "url"),
                            queries.rule_table(spark, RULES[:5]), ["page_id"])
    text = plan._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", text)


# ---- collocations

def plain_phrases(rows, least=30, most=2000, absorbed=80):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                of = f.setdefault((lang, size), Counter())
                of.update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang in n:
        found = []
        cands = {g: a for size in (2, 3, 4) for g, a in f[lang, size].items() if a >= least}
        for g, a in cands.items():
            if any(100 * b >= absorbed * a for h, b in cands.items() if len(h) > len(g)
                   and any(h[i:i + len(g)] == g for i in range(len(h)))):
                continue
            score, _, left, right = min(
                (2000000 * a // (f[lang, k][g[:k]] + f[lang, len(g) - k][g[k:]]), k,
                 f[lang, k][g[:k]], f[lang, len(g) - k][g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, k + 1, g.decode(), -a, left, right, n[lang], -score)
                for k, (score, a, g, left, right) in enumerate(sorted(found)[:most])]
    return grouped(out)


def got_phrases(docs, most=2000, **how):
    found = collocations.best(collocations.mine(docs, **how), most)
    return grouped(found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_phrases_awkward(spark):
    rng = random.Random(3)
    texts = [(row[1], rng.choice(["en", "fr", None, "und", ""])) for row in awkward()]
    texts += [("New York city. new  york\tCITY, New\x0bYork; new york", "en")] * 4
    texts += [("a a a a a a a", "en"), ("x" * 200 + " " + "x" * 200 + " y", "en"),
              ("\x00\x1f b \u2028 c\u00a0d", None), ("of the of the of the", "fr")] * 3
    docs = documents(spark, [(k, t, lang, "s") for k, (t, lang) in enumerate(texts)])
    rows = [(lang, t) for t, lang in texts]
    assert got_phrases(docs, least=3) == plain_phrases(rows, 3)
    assert got_phrases(docs, least=3, most=4) == plain_phrases(rows, 3, 4)


def test_phrases_over_shards(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_PHRASES", 40)
    texts = [prose(k, 400, vocabulary=25) for k in range(30)]
    docs = documents(spark, [(k, t) for k, t in enumerate(texts)])
    assert got_phrases(docs, least=5) == plain_phrases([("en", t) for t in texts], 5)


def test_phrases_empty(spark):
    assert got_phrases(documents(spark, [])) == []
    assert got_phrases(documents(spark, [(1, None), (2, ""), (3, "one two")])) == []


def test_parts_of_a_long_text_count_each_phrase_once(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 64)
    rng = random.Random(1)
    texts = ["".join(rng.choices(["ab", "c", " ", "\t", ". ", "d" * 90, "\n"], k=rng.randint(0, 300)))
             for _ in range(40)]
    batch = pa.RecordBatch.from_pydict({"text": [t.encode() for t in texts], "lang": ["en"] * 40,
                                        "mark": [7] * 40})
    got, want, names = Counter(), Counter(), {}
    for words, langs in collocations._read([batch], 11, 4):
        assert langs == ["en"]
        for k in range(len(words.code)):
            names[words.code[k]] = words.text[words.start[k]:words.end[k]].decode()
        for size, (_, here) in enumerate(collocations._phrase_codes(words, 4), 1):
            got.update(tuple(names[c] for c in words.code[k:k + size])
                       for k in np.flatnonzero(here & words.own[:len(here)]))
    for text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            found = re.findall(r"[^\x20\x09]+", piece)
            want.update(tuple(found[i:i + size]) for size in range(1, 5)
                        for i in range(len(found) - size + 1))
    assert got == want


@pytest.mark.parametrize("vocabulary,phrases", [(3, 60), (200, 900), (70_000, 3000)])
def test_trie_tells_every_phrase(vocabulary, phrases):
    rng = np.random.default_rng(vocabulary)
    codes = rng.integers(1, 1 << 63, vocabulary, dtype=np.uint64) * np.uint64(2)
    some = {tuple(codes[rng.integers(vocabulary, size=rng.integers(1, 5))]) for _ in range(phrases)}
    some |= {(c,) for c in codes}
    listed = sorted(some, key=len)
    table = np.zeros((len(listed), 4), np.uint64)
    for k, phrase in enumerate(listed):
        table[k, :len(phrase)] = phrase
    trie = collocations.Trie(table, np.array([len(p) for p in listed]))
    assert len(set(trie.states.tolist())) == len(listed)
    text = np.concatenate([np.array(p, np.uint64) for p in rng.permutation(
        np.array(listed, dtype=object))[:500]] + [np.array([5], np.uint64)])
    n = len(text)
    words = collocations.Words(text, np.append(np.ones(n - 1, bool), False), np.ones(n, bool),
                               None, None, None, b"")
    reached = Counter(np.concatenate(list(trie.advance(words, 4))).tolist())
    want = Counter(tuple(text[i:i + m].tolist()) for i in range(n) for m in range(1, 5)
                   if i + m <= n)
    for phrase, state in zip(listed, trie.states.tolist(), strict=True):
        assert reached[state] == want[tuple(int(c) for c in phrase)]


# ---- manifest

def digest(text):
    return sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    def leaf(values):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
        return out

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r), r) for r in rows if r[1] == source),
                     key=lambda x: x[:3])
        trees[source] = own, levels([x[2] for x in own])
    top = levels([trees[s][1][-1][0] for s in sources]) if sources else []
    out = []
    for place, source in enumerate(sources):
        own, tree = trees[source]
        for at, (_, _, node, r) in enumerate(own):
            first, siblings = node, ""
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                node = leaf((*r[:4], r[4].replace("\n", "")))
            for nodes, i in ((tree, at), (top, place)):
                for level in nodes[:-1]:
                    run = level[i // 3 * 3:i // 3 * 3 + 3]
                    siblings += "".join(run[:i % 3] + run[i % 3 + 1:])
                    run[i % 3] = node
                    node, i = digest("".join(run)), i // 3
            out.append((r[0], first, tree[-1][0], top[-1][0], digest(siblings), node,
                        node == top[-1][0]))
    return grouped(out)


@pytest.fixture
def manifest_of(spark, monkeypatch):
    def run(docs):
        monkeypatch.setattr(queries, "table", lambda *_: docs)
        return grouped(queries.op13_merkle_manifest(spark, "").collect())
    return run


def manifest_rows():
    rng = random.Random(8)
    rows = [(doc, rng.choice(["a", "b", None, "", "é"]), rng.choice(["en", None]),
             rng.choice([None, 5]), text) for doc, text in awkward()]
    rows += [(k, "hot", "en", 3, f"line\n{k}\n") for k in range(150)]
    return [*rows, *rows[:2], (None, "hot", None, None, None), (1, "only", "x", 1, "y\n")]


@pytest.mark.parametrize("piece,span", [(1 << 14, 9), (7, 2), (1, 1)])
def test_manifest_awkward(spark, manifest_of, monkeypatch, piece, span):
    monkeypatch.setattr(merkle, "PIECE", piece)
    monkeypatch.setattr(merkle, "SPAN", span)
    rows = manifest_rows()
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, source string, "
                                 "lang string, n_chars long, text string, row int, key string")
    assert manifest_of(docs) == plain_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_manifest_of_few_rows(manifest_of, spark, n):
    rows = [(k, "s" if k < 3 else "t", None, 1, "a\nb") for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, "
                                       "text string")
    assert manifest_of(docs) == plain_manifest(rows)


def test_largest_and_missing_nodes_make_the_whole_tree():
    for n in range(1, 60):
        for first in range(0, n, 5):
            end = min(n, first + 7)
            found = list(merkle.largest_nodes(first, [str(k) for k in range(first, end)], n))
            leaves = sorted(k for level, i, _, _ in found
                            for k in range(i * 3 ** level, min((i + 1) * 3 ** level, n)))
            assert leaves == list(range(first, end))
            lacking = list(merkle.missing(first, end, n))
            assert len(lacking) <= 4 * merkle.height(n) and len(set(lacking)) == len(lacking)


@pytest.mark.parametrize("name", ["op11_url_filter", "op12_collocations", "op13_merkle_manifest"])
def test_contract_columns(spark, sf_dir, name):
    df = getattr(queries, name)(spark, sf_dir)
    text = {"op11_url_filter": sql.url_sql(queries.URL_RULES, url_filter.ALLOW),
            "op12_collocations": sql.COLLOCATIONS_SQL, "op13_merkle_manifest": sql.MANIFEST_SQL}
    assert compare(df, connect(sf_dir), text[name]) is None
