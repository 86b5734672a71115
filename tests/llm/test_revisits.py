import random

import pytest
from llm_helpers import wide

from fleetlake.llm import revisits as r

SCHEMA = "capture_id long, url string, ts long, revisit boolean, headers map<string,string>, digest string"


def brute(rows):
    def key(url):
        import re
        m = re.match(r"(?s)([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(\?[^#]*)?", url or "")
        if not m:
            return None
        host = re.sub(r"^www\.", "", m[2].lower())
        host = host.removesuffix({"http": ":80", "https": ":443"}.get(m[1].lower(), "\0"))
        return host + (m[3] or "/") + (m[4] or "")

    out = []
    for c, url, ts, revisit, headers, _ in rows:
        if not revisit:
            continue
        headers = headers or {}
        base = None
        if None not in (c, ts, key(url)):
            full = [x for x in rows if not x[3] and key(x[1]) == key(url) and None not in (x[0], x[2]) and (x[2], x[0]) < (ts, c)]
            base = max(full, key=lambda x: (x[2], x[0]), default=None)
        stored = (base[4] or {}) if base else {}
        tag = lambda h: h.get("etag", "").strip().removeprefix("W/").removeprefix("w/")
        if not base:
            verdict = "no-base"
        elif "etag" in headers:
            verdict = "etag" if "etag" in stored and tag(headers) == tag(stored) else "mismatch"
        elif "last-modified" in headers:
            verdict = "last-modified" if headers["last-modified"] == stored.get("last-modified") else "mismatch"
        else:
            verdict = "unverified"
        good = verdict in ("etag", "last-modified")
        merged = {**stored, **{k: v for k, v in headers.items() if k in r.PERMITTED}} if good else None
        out.append(str((c, key(url), ts, base and base[0], base and base[2], verdict, merged and sorted(merged.items()),
                        base[5] if good else None)))
    return sorted(out)


def got(df):
    return sorted(str((*x[:6], x["headers"] and sorted(x["headers"].items()), x["digest"])) for x in r.resolve(df).collect())


def test_random_captures_with_one_hot_url(spark):
    draw = random.Random(3)
    rows = []
    for i in range(700):
        url = "http://hot.example/" if i % 3 else f"https://www.Site{draw.randrange(40)}.example:443/p?q=1#f{i}"
        headers = {"date": str(i), "content-type": "t"}
        if draw.random() < 0.7:
            headers["etag"] = draw.choice(['"a"', 'W/"a"', '"b"'])
        if draw.random() < 0.6:
            headers["last-modified"] = draw.choice(["m1", "m2"])
        rows.append((i, url, draw.randrange(200), draw.random() < 0.5, headers, f"d{i}"))
    df = wide(spark.createDataFrame(rows, SCHEMA)).repartition(7)
    assert got(df) == brute(rows)


def test_edges(spark):
    full = (1, "http://a.example", 5, False, {"etag": '"x"', "content-length": "9"}, "d")
    rows = [full, full, (2, "HTTP://user@WWW.A.example:80/#f", 5, True, {"etag": 'W/"x"', "content-length": "0", "expires": "e"}, None),
            (0, "http://a.example/", 5, True, {"etag": '"x"'}, None), (3, None, 6, True, {}, None), (4, "http://a.example/", None, True, None, None),
            (None, "http://a.example/", 9, True, None, None), (5, "http://a.example/", 9, True, None, None), (5, "http://a.example/", 9, True, None, None),
            (6, "http://a.example/", 4, None, None, None), (7, "not a url", 9, True, {"etag": '"x"'}, None), (8, "http://b.example/" + "x" * 50_000, 1, True, {}, None)]
    df = wide(spark.createDataFrame(rows, SCHEMA))
    assert got(df) == brute([(a, b, c, bool(d), e, f) for a, b, c, d, e, f in rows])
    assert r.resolve(df.limit(0)).count() == 0


@pytest.mark.parametrize("url,key", [("http://A.b", "a.b/"), ("https://a.b:80/x?y", "a.b:80/x?y"), ("mailto:x", None), (None, None)])
def test_canonical_url(spark, url, key):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(r.canonical_url(df["url"])).first()[0] == key
