"""The URL model against brute force."""

import itertools
import math
from collections import Counter, defaultdict

import pytest
import regex

from tastegraph.llm import queries as Q
from tastegraph.llm import urls
from tastegraph.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = r"[\p{L}\p{M}\p{N}]+"


def _score(words, known, total):
    return sum(math.log(known[w] / total) if w in known else math.log(10 / total) - len(w) * math.log(10) for w in words)


@pytest.mark.parametrize("label", ["", "a", "cheapflights", "qzxcheap", "catscats", "тестflat", "4chan", "flightsflat", "catsqqq9cat"])
def test_viterbi_finds_the_best_of_all_splits(label):
    known = {"cheap": 50, "flights": 20, "light": 9, "flat": 3, "cats": 4, "cat": 30, "s": 80, "a": 200, "chan": 2, "4": 1, "тест": 5}
    splits = [[label[a:b] for a, b in itertools.pairwise((0, *cut, len(label)))] for n in range(len(label))
              for cut in itertools.combinations(range(1, len(label)), n)] or [[]]
    got = urls.viterbi(label, known, 1000)
    assert "".join(got) == label
    assert _score(got, known, 1000) == pytest.approx(max(_score(w, known, 1000) for w in splits))


def test_words_and_labels_of_any_length(spark):
    long_ = "ab" * 50 + "c"
    model = spark.createDataFrame([("best", 100), (long_, 7), ("x" * 65, 3), ("ab" * 50 + "d", 2)], "word string, n long")
    labels = [f"best{long_}best", "q" * 300 + "best", "x" * 65, "", "best"]
    got = {r.label: r.words for r in urls.segmented(spark.createDataFrame([(x,) for x in labels], "label string"), model).collect()}
    assert got == {labels[0]: ["best", long_, "best"], labels[1]: ["q" * 300, "best"], labels[2]: ["x" * 65], "": [], "best": ["best"]}


def _plain(pages, rules):
    """The model's score of every page that no rule decides."""
    counts = Counter(w for p in pages for w in regex.findall(WORD, regex.sub("<[^>]*>", " ", p.html or "").lower()))
    total = sum(counts.values()) or 1
    left_out = {w for _, h, s in rules for w in regex.findall(WORD, (h + s).lower())}
    rows, words = [], {}
    for p in pages:
        m = regex.match(r"(?s).*?://([^/?#]*)([^?#]*)", p.url or "")
        host, path = (m[1].lower() if m else ""), (m[2] if m else "")
        fits = [(len(h + s), v) for v, h, s in rules if (host == h or host.endswith("." + h)) and path.startswith(s)]
        rows.append((p.page_id, host, path, max(fits)[1] if fits else None))
        if host not in words:
            words[host] = [w for label in regex.findall(WORD, host) for w in urls.viterbi(label, counts, total)]
    decided = Counter(h for _, h, _, v in rows if v)
    votes, hosts = defaultdict(lambda: [0.0, 0.0]), defaultdict(set)
    for _, host, path, v in rows:
        for w in (words[host] + regex.findall(WORD, path.lower())) if v else []:
            if w not in left_out:
                votes[w][v == "block"] += 1 / decided[host]
                hosts[w].add(host)
    votes = {w: n for w, n in votes.items() if len(hosts[w]) >= 2}
    a, b = (sum(n[i] for n in votes.values()) + len(votes) for i in (0, 1))
    weight = {w: math.log((n[1] + 1) / b) - math.log((n[0] + 1) / a) for w, n in votes.items()}
    return {i: sum(weight.get(w, 0.0) for w in words[host] + regex.findall(WORD, path.lower())) for i, host, path, v in rows if v is None}


def test_the_query_equals_a_plain_model(spark):
    pages = table(spark, SF, "pages").collect()
    expected = _plain(pages, Q.URL_RULES)
    rows = Q.op10_url_filter(spark, SF).collect()
    got = {r.page_id: r for r in rows if r.rule is None}
    assert len(rows) == len(pages) and got.keys() == expected.keys() and len(got) > 20
    for i, score in expected.items():
        assert got[i].score == pytest.approx(score, abs=2e-6)
        assert abs(score - urls.LEAST_ODDS) < 1e-5 or got[i].verdict == ("block" if score >= urls.LEAST_ODDS else "allow")


def test_it_learns_words_not_hosts(spark):
    """Words of blocked hosts block unseen hosts; a name on one host says nothing; a hot host has one vote."""
    rows = [(f"http://{n}casino{k}.bad.org/win/", "casino bet garden news winner roses") for n in ("best", "top", "my") for k in ("bet", "winner", "")] * 3
    rows += [(f"http://{n}garden{k}.good.org/tips/", "casino bet garden news best top my") for n in ("best", "top", "my") for k in ("news", "roses", "")] * 3
    rows += [("http://hot.good.org/tips/casino", "hot")] * 400  # one host's vote for the word
    rows += [("http://newcasinobet.net/win/", ""), ("http://newgardennews.net/tips/", ""), ("http://пример.рф/", "пример"), ("http://4chan.net/", "4 chan")]
    pages = spark.createDataFrame([(i, u, h, "mine", "mine") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, host string, score string")
    rules = [("block", "bad.org", "/"), ("allow", "good.org", "/")]
    got = {r.host: r for r in urls.judge(pages, rules).collect()}
    assert (got["newcasinobet.net"].verdict, got["newgardennews.net"].verdict) == ("block", "allow")
    assert got["пример.рф"].words[0] == "пример" and got["4chan.net"].words[0] in ("4", "4chan")
    assert got["пример.рф"].verdict == got["4chan.net"].verdict == "allow"
    assert got["hot.good.org"].verdict == "allow" and got["hot.good.org"].score is None
    held = {(r.ruled, r.verdict): r.n for r in urls.held_out_verdicts(pages, rules).collect()}
    assert held.get(("allow", "block"), 0) == 0 and sum(n for (a, _), n in held.items() if a == "block") > 0
    assert urls.judge(pages, []).filter("verdict = 'block'").count() == 0
