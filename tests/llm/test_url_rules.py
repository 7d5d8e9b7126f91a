import itertools
import math
import random

from saletrace.llm import url_rules


def naive(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("#")[0].split("?")[0]
    fit = [(len(h + p), h + p, v) for v, h, p in url_rules.CURATED
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


ODD = [None, "", "no scheme", "http://", "://x.org/", "http://a.org", "HTTP://A.ORG/x?y=/#z",
       "http://example.org/es/1", "http://sub.EXAMPLE.org/en/12", "http://notexample.org/es/1",
       "http://com/fr/", "http://a.com?x=/de/", "http://a.com/de/#q", "http://org/x", "a://b://c.org/",
       "http://ÄB.org/é", "http://a.net/" + "x" * 100_000, "http://u:p@a.org:80/x",
       "http://example.org/en/2", "http://a.net/de/5", "http://a.net/de/5"]


def pages(spark, urls, clash=False):
    extra = "".join(f", `{c}` string" for c in ("id", "tokens", "sign", "host")) if clash else ""
    return spark.createDataFrame([(i if i % 5 else None, u) + (("c",) * 4 if clash else ())
                                  for i, u in enumerate(urls)],
                                 "page_id bigint, url string" + extra)


def test_host_path_and_rule(spark):
    out = url_rules.url_verdicts(pages(spark, ODD, clash=True), support=0.3).collect()
    got = sorted((r.page_id is None, r.page_id or 0, r.host, r.path, r.rule or "") for r in out)
    want = []
    for i, u in enumerate(ODD):
        host, path, rule, verdict = naive(u)
        want.append((not i % 5, i if i % 5 else 0, host, path, rule or ""))
    assert got == sorted(want)
    for r in out:
        if r.rule:
            assert r.verdict == {h + p: v for v, h, p in url_rules.CURATED}[r.rule]
    none = pages(spark, [])
    assert url_rules.url_verdicts(none).count() == 0
    assert {r.verdict for r in url_rules.url_verdicts(pages(spark, [None, "x"])).collect()} == {"allow"}


def test_mined_rules_equal_brute_force(spark):
    r = random.Random(1)
    urls = [f"http{r.choice(['', 's'])}://{r.choice('abc')}.{r.choice(['example.org', 'site.com'])}"
            f"/{r.choice(['de', 'fr', 'en', 'es'])}/{r.randint(1, 30)}{r.choice(['', '.html'])}"
            for _ in range(400)] + [f"http://x.net/{p}/{k}" for p in ("de", "es", "en") for k in range(9)]
    judged = url_rules.judged_urls(pages(spark, urls)).collect()
    known = [(frozenset(x.tokens), x.verdict) for x in judged if x.rule]
    support, confidence, least = 0.05, 0.8, 20
    fewest = max(support * len(known), least)

    def bound(k, n, z=1.6448536269514722):
        p = k / n
        return ((p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n)))
                / (1 + z * z / n))

    items = sorted({t for s, _ in known for t in s if sum(t in u for u, _ in known) >= fewest})
    found = {}
    for k in range(1, 8):
        for c in itertools.combinations(items, k):
            c = frozenset(c)
            hit = [v for s, v in known if c <= s]
            block = hit.count("block")
            if block >= fewest and bound(block, len(hit)) >= confidence:
                found[c] = block / len(hit)
    want = {c for c in found if not any(d < c and found[d] >= found[c] for d in found)}
    labelled = url_rules.judged_urls(pages(spark, urls)).filter("rule is not null")
    mined = url_rules.mine_rules(labelled.select("tokens", "verdict"), support, confidence).collect()
    # a rule stands for every choice of one token from each of its classes
    stated = [frozenset(c) for x in mined for c in itertools.product(*x.alike)]
    assert len(stated) == len(set(stated)) and set(stated) == want and want
    assert all(x.bound >= confidence and x.support * len(known) >= least - 1e-6 for x in mined)
    spelled = [set(c) for c in url_rules.curated_tokens(url_rules.CURATED)]
    assert {frozenset(x.tokens): x.repeats for x in mined} == {
        frozenset(x.tokens): any(all(set(c) & s for c in x.alike) for s in spelled) for x in mined}
    out = url_rules.url_verdicts(pages(spark, urls), support=support, confidence=confidence).collect()
    tokens = sorted((x.host, x.path, x.rule is None, any(c <= set(x.tokens) for c in want))
                    for x in judged)
    got = sorted((x.host, x.path, x.rule is None, x.verdict == "block" if x.rule is None else False)
                 for x in out)
    assert [t[:3] + (t[3] and t[2],) for t in tokens] == got


def test_tokens_that_always_meet_are_one(spark):
    """Thirty tokens of the same URLs would be a thousand million
    combinations; any one of them blocks, on an undecided host too."""
    query = "&".join(f"k{i}=1" for i in range(30))
    urls = [f"http://a.com/de/{i}?{query}" for i in range(40)]
    urls += [f"http://a.org/x/{i}" for i in range(40)]
    urls += ["http://z.net/y?k7=2", "http://z.net/y?q=2"]
    out = {r.page_id: r.verdict for r in url_rules.url_verdicts(spark.createDataFrame(
        list(enumerate(urls)), "page_id bigint, url string")).collect()}
    assert out[80] == "block" and out[81] == "allow"


def test_no_rule_from_few_urls(spark):
    """Nineteen blocked URLs, all alike, are too few for a rule; so are 24,
    whose confidence is not yet bounded by 0.9; 25 are enough."""
    for n, verdict in ((19, "allow"), (24, "allow"), (25, "block")):
        urls = [f"http://a.com/de/{i}?bad=1" for i in range(n)]
        urls += [f"http://a.org/x/{i}" for i in range(60)] + ["http://z.net/y?bad=1"]
        out = url_rules.url_verdicts(spark.createDataFrame(
            list(enumerate(urls)), "page_id bigint, url string")).collect()
        assert {r.verdict for r in out if r.host == "z.net"} == {verdict}, n
