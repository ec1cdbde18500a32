"""Rules, templates and verdicts against brute force."""

from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from tripworks.llm import addresses
from tripworks.llm.addresses import rules
from tripworks.llm.frames import prepare

SCHEMA = "page_id bigint, url string, host string, path string, rule int, verdict string, template string"
GIVEN = ["allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/"]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(url):
    host, path = split(url)
    fits = []
    for line in GIVEN:
        verdict, address = line.split(" ")
        name, _, rest = address.partition("/")
        if (host == name or host.endswith(f".{name}")) and path.startswith(f"/{rest}"):
            fits.append((len(address), address, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "x", "http://", "http://com", "http://com/", "HTTP://A.Example.COM/en/1", "https://www.example.com/en/2?x=/fr/", "https://www.example.com/enx",
    "http://notexample.com/en/1", "ftp://n.net/es/", "http://n.net/es", "http://n.net/fr/x#y", "http://n.net?/fr/", "http://n.net#://a.com/", "a://b://c.com/",
    "http://ÄÖ.net/fr/ü", "http://n.net/fr/" + "a/" * 5000, "http://n.net/en/\nfr/", "//n.net/es/",
]


def test_hosts_paths_and_rules(spark):
    prepare(spark)
    df = spark.createDataFrame([(i, u, "h", "p", 1, "v", "t") for i, u in enumerate(URLS)], SCHEMA)
    for r in addresses.judge(df, rules(*GIVEN)).collect():
        url = URLS[r["page_id"]]
        assert (r["host"], r["path"]) == split(url)
        rule, verdict = brute_rule(url)
        assert r["rule"] == rule and (verdict is None or r["verdict"] == verdict)
    assert addresses.judge(df.limit(0), rules(*GIVEN)).count() == 0


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")


def test_unruled_pages_follow_the_templates_of_their_host(spark):
    """Blocked by rule: /ads/ up to item 99 of a host. The rest of /ads/ goes with it, /news/ and other hosts do not."""
    prepare(spark)
    given = [addresses.Rule("block", "a.org", f"/ads/{d}") for d in range(1, 6)] + [addresses.Rule("allow", "a.org", "/news/1")]
    urls = [f"http://a.org/ads/{n}" for n in range(1, 100)] + [f"http://a.org/news/{n}" for n in range(1, 100)]
    urls += [f"http://a.org/{quote('one-off')}-{chr(97 + n % 26)}{chr(97 + n // 26)}/x" for n in range(60)] + [f"http://b.org/ads/{n}" for n in range(1, 50)]
    found = {r["page_id"]: r for r in addresses.judge(pages(spark, urls), given).collect()}
    for i, url in enumerate(urls):
        assert found[i]["verdict"] == ("block" if url.startswith("http://a.org/ads/") else "allow"), url
    assert {found[i]["template"] for i in range(99)} == {"/ads/{n}"}
    assert {found[i]["template"].split("/")[1] for i in range(198, 258)} == {"*"}


def test_alike_branches_are_merged_and_unlike_ones_are_not(spark):
    prepare(spark)
    given = rules("block a.org/x/", "block a.org/y/", "allow a.org/z/")
    urls = [f"http://a.org/{s}/{n}" for s in "xyzw" for n in range(40)]
    found = {r["page_id"]: r for r in addresses.judge(pages(spark, urls), given).collect()}
    labels = {urls[i].split("/")[3]: r["template"].split("/")[1] for i, r in found.items()}
    assert labels == {"x": "x|y", "y": "x|y", "z": "z", "w": "w"}
    assert all(r["verdict"] == ("block" if urls[i].split("/")[3] in "xy" else "allow") for i, r in found.items())
    purity = {urls[i].split("/")[3]: r["purity"] for i, r in found.items()}
    assert purity["x"] < 0.1 and purity["z"] > 0.9 and purity["w"] == addresses.PRIOR


@pytest.mark.parametrize("url,shape", [("http://h/a1/22.html", ["a{n}", "{n}.html"]), ("http://h", [""]), ("http://h/", [""]), ("http://h/a/", ["a", ""])])
def test_shapes(spark, url, shape):
    _, path = addresses.parts(F.col("url"))
    assert pages(spark, [url]).select(addresses.shape(path).alias("s")).first()["s"] == shape


def test_deep_paths_are_told_apart_at_any_depth(spark):
    prepare(spark)
    deep = "http://h.com/" + "a/" * 14
    urls = [f"{deep}{kind}/{i}/{word}" for kind in ("good", "bad") for i in range(30) for word in ("x", "y")] + ["http://h.com/" + "b/" * 3000]
    given = rules(f"allow h.com/{'a/' * 14}good/1", f"block h.com/{'a/' * 14}bad/1")
    found = {urls[r["page_id"]]: r for r in addresses.judge(pages(spark, urls), given).collect()}
    assert {r["verdict"] for u, r in found.items() if "/good/" in u} == {"allow"}
    assert {r["verdict"] for u, r in found.items() if "/bad/" in u} == {"block"}
    assert found[urls[-1]]["verdict"] in ("allow", "block")


def test_blocked_pages_go(spark):
    prepare(spark)
    df = spark.createDataFrame([(i, u, "h", "p", 1, "v", "t") for i, u in enumerate(URLS)] * 2, SCHEMA)
    kept = addresses.allowed(df, rules(*GIVEN))
    assert kept.dtypes == df.dtypes
    judged = addresses.judge(df, rules(*GIVEN)).where("verdict = 'allow'")
    left = sorted(r["page_id"] for r in kept.collect())
    assert left == sorted(r["page_id"] for r in judged.collect())
    assert not any(brute_rule(URLS[i])[1] == "block" for i in left)
    assert set(left) >= {i for i, u in enumerate(URLS) if brute_rule(u)[1] == "allow"}


def test_plan_holds_no_python(spark):
    plan = addresses.judge(pages(spark, ["http://a.net/es/1"]), rules(*GIVEN))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
