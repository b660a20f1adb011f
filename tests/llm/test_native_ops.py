"""URL verdicts and tool calls: SQL on the given tables, plain versions on odd rows."""

import json
import math
import random

import pytest

import __spark_entry__ as driver
from cohortloom.llm import tool_calls, url_filter
from tests.compare import compare, duck

PAGES = "page_id long, url string, host string, bad int"


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op3_url_filter", "op9_tool_calls"])
def test_query_equals_sql(spark, sf_dir, name):
    difference = compare(
        spark, duck(sf_dir), driver.queries()[name], driver.oracle_sql()[name], sf_dir
    )
    assert difference is None


URLS = {
    None: ("", "", None),
    "": ("", "", None),
    "no scheme/path": ("", "", None),
    "http://A.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/"),
    "http://example.net/fr/": ("example.net", "/fr/", "net/"),
    "http://example.net": ("example.net", "", None),
    "http://example.net?q=/en/": ("example.net", "", None),
    "x://notexample.net/en/": ("notexample.net", "/en/", "net/"),
    "https://b.example.com/de/1": ("b.example.com", "/de/1", "example.com/de/"),
    "https://b.example.com/DE/1": ("b.example.com", "/DE/1", None),
    "https://c.org/fr/://d.net/": ("c.org", "/fr/://d.net/", "org/fr/"),
    "a\nb://ÄB.org/fr/\nline": ("Äb.org", "/fr/\nline", "org/fr/"),
    "://": ("", "", None),
    "http://e.net:80/": ("e.net:80", "/", None),
}


def test_url_rules(spark):
    rows = [(i, u, "clash", 1) for i, u in enumerate(URLS)] + [(None, "http://x.net/", "c", 0)]
    pages = spark.createDataFrame(rows, PAGES)
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: r for r in url_filter.url_verdicts(pages, none).collect()}
    verdicts = {n + p: v for v, n, p in url_filter.RULES}
    for i, (host, path, rule) in enumerate(URLS.values()):
        assert tuple(got[i]) == (i, host, path, rule, verdicts.get(rule, "allow"))
    assert len(got) == len(rows) and got[None].verdict == "block"
    assert url_filter.url_verdicts(pages.limit(0), none).count() == 0


def test_registered_domains(spark):
    want = {
        "a.b.example.com": ("example.com", "com"),
        "example.com": ("example.com", "com"),
        "com": ("com", "com"),
        "x.a.co.uk": ("a.co.uk", "co.uk"),
        "b.co.uk:8080": ("b.co.uk", "co.uk"),
        "co.uk": ("co.uk", "co.uk"),
        "me.github.io": ("me.github.io", "github.io"),
        "10.1.2.3": ("10.1.2.3", ""),
        "10.1.2.4:80": ("10.1.2.4", ""),
        "": ("", ""),
    }
    rows = spark.createDataFrame([(h,) for h in want], "host string")
    domain, suffix = url_filter.parents(rows["host"])
    got = rows.select("host", domain.alias("d"), suffix.alias("s")).collect()
    assert {r.host: (r.d, r.s) for r in got} == want


def test_pages_are_blocked_through_domain_and_suffix(spark):
    """Hosts without a label of their own, in a bad domain, under a bad suffix, and elsewhere."""
    urls, labels = [], []

    def pages(host, n, bad):
        for k in range(n):
            urls.append((len(urls), f"http://{host}/{k}", "c", 0))
            if bad is not None:
                labels.append((len(urls) - 1, int(k < bad)))

    for d in range(12):
        for h in range(4):
            pages(f"h{h}.good{d}.com", 30, 1)
            pages(f"h{h}.bad{d}.biz", 30, 29)
    for h in range(4):
        pages(f"h{h}.spam.com", 60, 60)
    for host in ("new.spam.com", "new.unseen.biz", "new.good1.com", "new.unseen.com"):
        pages(host, 2, None)
    got = url_filter.url_verdicts(
        spark.createDataFrame(urls, PAGES),
        spark.createDataFrame(labels, "page_id long, bad int"),
        rules=(),
        details=True,
    ).collect()
    verdicts = {r.host: (r.verdict, r.n) for r in got}
    assert verdicts["new.spam.com"] == ("block", 0) and verdicts["h1.bad3.biz"] == ("block", 30)
    assert verdicts["new.good1.com"] == ("allow", 0) and verdicts["h1.good3.com"] == ("allow", 30)
    assert verdicts["new.unseen.biz"][0] == "block" and verdicts["new.unseen.com"][0] == "allow"
    assert len(got) == len(urls) and all(0 < r.low < r.mean < 1 for r in got)


def plain_reputation(hosts, limits=url_filter.Limits()):
    """hosts: name -> (n, bad)."""

    def family(level):
        out = {}
        for name, (n, bad) in hosts.items():
            labels = name.split(".")
            key = {"host": name, "domain": ".".join(labels[-2:]), "suffix": labels[-1], "all": "all"}[level]
            a, b = out.get(key, (0, 0))
            out[key] = (a + n, b + bad)
        return out

    def up(name, level):
        return "all" if level == "all" else name.split(".")[-1] if level == "suffix" else ".".join(name.split(".")[-2:])

    def strength(children, parent_level):
        parents = family(parent_level)
        extra = scale = 0.0
        for p, (pn, pb) in parents.items():
            own = [(n, b) for c, (n, b) in children.items() if up(c, parent_level) == p and n]
            if not own:
                continue
            rate = pb / pn
            noise = rate * (1 - rate)
            extra += sum(n * (b / n - rate) ** 2 for n, b in own) - noise * (len(own) - 1)
            scale += noise * (sum(n for n, _ in own) - sum(n * n for n, _ in own) / pn - len(own) + 1)
        if scale <= 0:
            return 9999.0
        return 1 / min(max(extra / scale, 1e-4), 0.9) - 1

    (n, bad) = family("all")["all"]
    s = strength(family("suffix"), "all")
    d = strength(family("domain"), "suffix")
    h = strength(hosts, "domain")
    out = {}
    for name, (hn, hb) in hosts.items():
        sn, sb = family("suffix")[up(name, "suffix")]
        dn, db = family("domain")[up(name, "domain")]
        rate = (sb + s * (bad + 1) / (n + 2)) / (sn + s)
        rate = (db + d * rate) / (dn + d)
        mean = (hb + h * rate) / (hn + h)
        low = mean - limits.bound * math.sqrt(mean * (1 - mean) / (hn + h + 1))
        out[name] = (mean, low, "block" if low > limits.bad_rate else "allow")
    return out


def test_host_reputation(spark):
    draw = random.Random(2)
    hosts = {}
    for d in range(8):
        for h in range(6):
            n = draw.choice([0, 1, 3, 40])
            rate = 0.95 if h == 0 else 0.1
            hosts[f"h{h}.site{d}.{'com' if d % 2 else 'org'}"] = (n, sum(draw.random() < rate for _ in range(n)))
    rows = spark.createDataFrame([(k, n, b) for k, (n, b) in hosts.items()], "host string, n long, bad long")
    want = plain_reputation(hosts)
    got = url_filter.host_reputation(rows).collect()
    assert {r.host for r in got} == set(want)
    for r in got:
        mean, low, verdict = want[r.host]
        assert (r.mean, r.low) == pytest.approx((mean, low), abs=1e-6) and r.verdict == verdict
    assert {r.verdict for r in got if r.n == 40 and r.host.startswith("h0")} == {"block"}
    assert {r.verdict for r in got if r.n == 40 and not r.host.startswith("h0")} == {"allow"}


SCHEMAS = {
    "add": {"a": tool_calls.Field("integer", minimum=0, maximum=9), "b": tool_calls.Field("number", required=False)},
    "say": {"word": tool_calls.Field("string", min_length=1, max_length=3, choices=("a", "bb")), "x y": tool_calls.Field("array", required=False)},
    "none": {},
}
CALLS = "conv_id long, call_id string, position long, name string, arguments string, after string, level int"
RESULTS = "conv_id long, call_id string, position long, content string, status string"


def check_faults(spark, name, arguments):
    rows = spark.createDataFrame([(1, "c", 0, name, arguments, None, 5)], CALLS)
    empty = spark.createDataFrame([], RESULTS)
    return tool_calls.link_tool_calls(rows, empty, SCHEMAS).first()


@pytest.mark.parametrize(
    "name, arguments, faults",
    [
        ("add", '{"b":1.5,"a":3}', []),
        ("add", '{"a":"3"}', ["a: not integer"]),
        ("add", '{"a":12,"z":1,"c":null}', ["a: too large", "c: unknown", "z: unknown"]),
        ("add", "{}", ["a: missing"]),
        ("add", "[1]", ["arguments: not an object"]),
        ("add", "{broken", ["arguments: not an object"]),
        ("add", None, ["arguments: not an object"]),
        ("say", '{"word":"bb","x y":[1,"2"]}', []),
        ("say", '{"word":"cccc"}', ["word: too long", "word: not allowed"]),
        ("none", "{}", []),
        ("none", '{"q":{}}', ["q: unknown"]),
        ("other", "{}", ["unknown tool"]),
        (None, "{}", ["unknown tool"]),
    ],
)
def test_argument_faults(spark, name, arguments, faults):
    assert check_faults(spark, name, arguments).faults == faults


def test_canonical_json(spark):
    row = check_faults(spark, "add", ' { "b" : 1 ,\n "a":{"d":[1, {"y":2,"x":"é\\n"}],"c":null}}')
    assert row.line == (
        '{"arguments":{"a":{"c":null,"d":[1,{"x":"é\\n","y":2}]},"b":1},'
        '"id":"c","level":0,"name":"add","status":"no_result"}'
    )


def test_tool_calls_on_odd_rows(spark):
    calls, results, after = [], [], {}
    for i in range(200):  # a chain in which later calls come first
        calls.append((1, f"c{i}", 1000 - i, "none", "{}", f"c{i - 1}" if i else None, 0))
        results.append((1, f"c{i}", 2000 + i, f"r{i}", "x"))
    calls += [(2, "a", 0, "none", "{}", "b", 0), (2, "b", 1, "none", "{}", "a", 0), (2, "c", 2, "none", "{}", "a", 0)]
    calls += [(3, "a", 5, "none", "{}", "gone", 0), (3, "a", 4, "none", "{}", None, 0), (3, "a", 4, "none", "{}", None, 0)]
    calls += [(None, "a", 0, "none", "{}", None, 0), (4, None, 0, "none", "{}", None, 0)]
    results += [(3, "a", 3, None, "x"), (3, "only", 1, "alone", "x"), (None, None, 0, "z", "x"), (3, "a", 9, "later", "x")]
    got = {
        (r.conv_id, r.call_id): r
        for r in tool_calls.link_tool_calls(
            spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS
        ).collect()
    }
    assert len(got) == 200 + 3 + 2
    for i in range(200):
        row = got[1, f"c{i}"]
        assert (row.level, row.status, row.copies) == (i, "linked", 2)
        assert json.loads(row.line)["result"] == f"r{i}"
    assert [got[2, k].level for k in "abc"] == [None] * 3
    assert (got[3, "a"].status, got[3, "a"].copies, got[3, "a"].level) == ("early_result", 5, 0)
    assert (got[3, "only"].status, got[3, "only"].faults) == ("no_call", [])


def test_turns_as_calls(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", None), (1, 1, "assistant", None), (1, 2, "user", "x" * 3000), (1, 2, "user", "x"), (None, 0, "user", "q"), (2, None, "user", "q"), (1, 3, None, "q")],
        "conv_id long, turn long, role string, text string",
    )
    rows = tool_calls.link_tool_calls(*tool_calls.calls_of_conversations(turns), tool_calls.REPLY).collect()
    got = {r.call_id: (r.status, r.faults, r.copies, r.level) for r in rows}
    assert got == {
        "call_0": ("linked", ["n_chars: too small", "prompt: too short"], 2, 0),
        "call_2": ("no_result", [], 2, 1),
    }
