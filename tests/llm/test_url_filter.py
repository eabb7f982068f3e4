import math
import random
import re
from collections import Counter, defaultdict

from shelfscope.llm.url_filter import ALPHA, MIN_CHILDREN, MIN_SHARE, RULES, Z, judge


def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_for(host, path):
    best = None
    for what, text in RULES:
        h, p = text[:text.index("/")], text[text.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(text) > len(best[1])):
            best = (what, text)
    return best


def brute(rows):
    pages = []
    for page, url in rows:
        host, path = split(url)
        segs = [s for s in re.sub("[0-9]+", "#", path).split("/") if s]
        pages.append([page, host, path, rule_for(host, path), segs, ()])
    for level in range(max((len(p[4]) for p in pages), default=0)):
        own = Counter((p[1], p[5], p[4][level]) for p in pages if len(p[4]) > level)
        total, children = Counter(), Counter()
        for (h, t, _), n in own.items():
            total[h, t] += n
            children[h, t] += 1
        for p in pages:
            if len(p[4]) > level:
                k = p[1], p[5]
                var = children[k] >= MIN_CHILDREN and own[(*k, p[4][level])] < MIN_SHARE * total[k]
                p[5] = (*p[5], "*" if var else p[4][level])
    count = lambda key: {k: [sum(1 for p in pages if key(p) == k and p[3] and p[3][0] == w) for w in ("allow", "block")] for k in {key(p) for p in pages}}
    node = count(lambda p: (p[1], p[5]))
    parent = defaultdict(lambda: [0, 0])
    up = lambda t: t[:-1] if t else None
    for (h, t), (a, b) in node.items():
        parent[h, up(t)][0] += a
        parent[h, up(t)][1] += b
    group_of, group, any_ = {}, defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for (h, t), (a, b) in node.items():
        pa, pb = parent[h, up(t)]
        whole = pb / (pa + pb) if pa + pb else None
        similar = a + b == 0 or abs(b / (a + b) - whole) <= Z * math.sqrt(whole * (1 - whole) / (a + b)) + 1e-12
        group_of[h, t] = (h, up(t), "**") if similar else (h, t)
        for into in (group[group_of[h, t]], any_[t]):
            into[0] += a
            into[1] += b
    a, b = (sum(n[i] for n in node.values()) for i in (0, 1))
    overall = b / (a + b) if a + b else 0
    out = []
    for page, host, path, rule, _, t in pages:
        prior = (any_[t][1] + ALPHA * overall) / (sum(any_[t]) + ALPHA)
        g = group[group_of[host, t]]
        purity = (g[1] + ALPHA * prior) / (sum(g) + ALPHA)
        out.append((page, host, path, rule and rule[1], rule[0] if rule else "block" if purity > 0.5 else "allow", "/" + "/".join(t)))
    return sorted(out, key=str)


def _rows():
    rnd = random.Random(4)
    rows = []
    for k in range(900):
        host = rnd.choice(["a.example.org", "b.com", "Big.Net", "big.net", "big.net", "x.example.org", "com"])
        path = rnd.choice(["/en/{}", "/de/{}.html", "/fr/{}/", "/es/x{}", "/user/{w}/profile", "/tag/{w}", "", "/", "/de", "/u/{w}/{}/z"])
        path = path.replace("{w}", "".join(rnd.choices("abcd", k=4))).replace("{}", str(rnd.randint(0, 3000)))
        rows.append((k, f"{rnd.choice(['http', 'https'])}://{host}{path}{rnd.choice(['', '?q=1', '#top', '?a=/b#c'])}"))
    rows += [(2000, None), (2001, ""), (2002, "no scheme/en/1"), (2003, "x://"), (2004, "://ÄB.org/É?x"), (2005, "a://b://c/d"),
             (None, "http://a.example.org/en/1"), (7, rows[7][1]), (2006, "http://long.org/" + "s/" * 3000), (2007, "http://org"), (2008, "h://evilorg/")]
    return rows


def test_matches_brute_force(spark):
    rows = _rows()
    pages = spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, host string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.template) for r in judge(pages).collect()), key=str)
    assert got == brute(rows)
    assert len({r[5] for r in got if "*" in r[5]}) >= 2 and {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_no_level_is_too_deep(spark):
    """A segment that varies below 18 common ones becomes a wildcard, and what hangs below it is followed on."""
    letters = "abcdefghijklmnopqrstuvwxyzabcdefgh"
    rows = [(k, f"http://deep.net/{'s/' * 18}{letters[k % 26]}{k // 26 * 'x'}y/t/{'uvw'[k % 3]}") for k in range(50)]
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.template)
                  for r in judge(spark.createDataFrame(rows, "page_id long, url string")).collect()), key=str)
    assert got == brute(rows)
    assert {r[5] for r in got} == {"/" + "s/" * 18 + "*/t/" + c for c in "uvw"}


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    plan = judge(pages)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty(spark):
    assert judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
