import re
from collections import Counter
from itertools import combinations

from periodix.llm.queries import URL_RULES
from periodix.llm.url_filter import judge

URLS = [
    (0, "http://a.example.net/en/1"), (1, "http://example.net/de/2?x=1"), (2, "HTTP://WWW.Example.COM/de/3#top"), (3, "https://b.example.com/DE/3"),
    (4, "http://x.org/fr/4.html"), (5, "http://x.org/fr"), (6, "http://x.org/en/77"), (7, "http://notnet/en/"), (8, "http://net"), (9, "http://net/"),
    (10, "ftp://u:p@h.net:21/x"), (11, "example.net/en/1"), (12, None), (13, ""), (14, "a://b://c/d"), (15, "http://x.com?q=net/"), (16, "://\n/p\nq"),
    (17, "http://É.ORG/fr/é"), (9, "http://net/"), (None, "http://spam.net/x/1"), (18, "http://spam.org/x/22?x=9"),
] + [(100 + i, f"http://s{i}.net/x/{i}") for i in range(20)] + [(200 + i, f"http://s{i}.org/fr/{i}?ref=a") for i in range(20)] + [
    (300 + i, f"https://s{i}.com/{'x' if i % 2 else 'en'}/{i}{'?ref=b' if i % 3 else ''}") for i in range(20)]


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate({c: c + 32 for c in range(65, 91)}), re.match(r"[^?#]*", rest[len(host):]).group()


def rule_of(host, path):
    best = None
    for verdict, rule in URL_RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best


def tokens(url):
    host, path = host_path(url)
    if url is None:
        return frozenset()
    zero = lambda s: re.sub("[0-9]+", "0", s)
    labels = zero(host).split(".")
    query = re.search(r"\?([^#]*)", url, re.S)
    fragment = re.search(r"#(.*)$", url, re.S)
    out = [f"host:{x}" for x in labels[:-1] if x] + [f"end:{x}" for x in labels[-1:] if x]
    out += [f"path:{x}" for x in zero(path).lower().split("/") if x]
    out += [f"query:{x.split('=')[0]}" for x in zero(query.group(1)).lower().split("&") if x.split("=")[0]] if query else []
    out += [f"fragment:{zero(fragment.group(1)).lower()}"] if fragment and fragment.group(1) else []
    return frozenset(out)


def brute(urls, min_support, min_confidence):
    """Every combination of up to three tokens, counted."""
    labelled = [(tokens(u), rule_of(*host_path(u))[0]) for _, u in urls if rule_of(*host_path(u)) and tokens(u)]
    every, marked = Counter(), Counter()
    for have, label in labelled:
        for n in (1, 2, 3):
            for c in combinations(sorted(have), n):
                every[c] += 1
                marked[c, label] += 1
    least = -(-min_support * len(labelled) // 1)
    share = {k: v / every[k[0]] for k, v in marked.items() if v >= least}
    rules = [(c, label) for (c, label), s in share.items() if s >= min_confidence and not any(
        share.get((part, label), 0) >= s for n in range(1, len(c)) for part in combinations(c, n))]
    out = []
    for i, u in urls:
        host, path = host_path(u)
        listed = rule_of(host, path)
        if listed:
            out.append((i, host, path, listed[1], listed[0]))
            continue
        fits = [(share[c, label], marked[c, label], len(c), " ".join(c), label) for c, label in rules if set(c) <= tokens(u)]
        out.append((i, host, path, None, max(fits)[4] if fits else "allow"))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h", 1, "t") for i, u in URLS], "page_id long, url string, host string, rule int, tokens string")
    rows = judge(pages, URL_RULES, min_support=0.05, min_confidence=0.8).collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows), key=str) == brute(URLS, 0.05, 0.8)
    mined = [r for r in rows if r.rule is None and r.evidence]
    assert {r.verdict for r in mined} == {"allow", "block"}


def test_without_rows_or_labels(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    assert judge(pages.where("false"), URL_RULES).count() == 0
    assert {r.verdict for r in judge(pages, []).collect()} == {"allow"}


def test_long_common_urls_do_not_multiply(spark):
    """Thirty path segments that the same urls share, under both verdicts: 2**30 sets if they were told apart."""
    path = "/".join(f"part{chr(97 + i)}" for i in range(26)) + "/x/y/z/w"
    pages = [(i, f"http://s.net/{path}") for i in range(40)] + [(100 + i, f"http://s.org/fr/{path}") for i in range(40)] + [(300, f"http://t.com/{path}"), (301, "http://t.com/")]
    rows = {r.page_id: r for r in judge(spark.createDataFrame(pages, "page_id long, url string"), URL_RULES, min_confidence=0.5).collect()}
    assert rows[0].verdict == "block" and rows[100].verdict == "allow" and len(rows) == len(pages)
    assert rows[300].evidence.startswith("path:") and rows[301].evidence is None
