"""URL filter against a plain scan of all rules."""

import random

import numpy as np
import pytest

from marginalia.llm import url_filter as uf

RULES = [("org", "/", "allow"), ("Example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("net", None, "block"),
         ("a.net", "", "allow"), ("é.net", "/ü", "block"), (None, "/", "block"), ("", "/", "block"), ("dup.org", "/", "allow"), ("dup.org", "/", "block"), ("bad.org", "x", "block"),
         ("no.org", "/", None)]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = rest[: min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))]
    path = rest[len(host) :]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for h, p, v in RULES:
        h, p = (h or "").lower(), p or ""
        if h and v and (not p or p[0] == "/") and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len((h + p).encode()), len(h.encode()), v, h + p))
    if not fits:
        return host, path, None, "allow"
    _, _, v, rule = max(fits)
    return host, path, rule, v


def urls():
    rng = random.Random(5)
    hosts = ["org", "example.org", "WWW.example.ORG", "notexample.org", "x.com", "com", "net", "b.a.net", "é.net", "dup.org", "bad.org", ".", "a..net", ".net", "no.org", "", "u@net:80"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/148.html", "/fr/x?y#z", "/de/#://", "?q=/es/", "#/", "/ü", "/üü", "//", "/a\nb"]
    out = [None, "", "no scheme", "://", "http:/x", "http://" + "a." * 20_000 + "net/", "http://example.org/en/1" + "x" * 100_000]
    return out + [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)] + ["http://example.org/es/1"] * 3


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_equals_a_scan_of_all_rules(spark, max_bytes):
    us = urls()
    pages = spark.createDataFrame([(None if k == 5 else k // 2, u) for k, u in enumerate(us)], "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule", "1 as entry")
    got = uf.judge(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"), max_bytes=max_bytes).collect()
    want = [(None if k == 5 else k // 2, *plain(u)) for k, u in enumerate(us)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    one = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    for max_bytes in (1 << 20, -1):
        assert [tuple(r) for r in uf.judge(one, none, default="block", max_bytes=max_bytes).collect()] == [(1, "a.org", "/x", None, "block")]
        assert uf.judge(one.limit(0), none, max_bytes=max_bytes).count() == 0


def test_stored_strings_decide_where_keys_collide(tmp_path):
    rows = [{"entry": e, "verdict": "allow", "lengths": []} for e in ("a", "b", "c/d")]
    uf._write_array(rows, str(tmp_path / "rules"))
    array = uf.DigestArray(str(tmp_path / "rules"))
    assert isinstance(array.keys.base, np.memmap) or isinstance(array.keys, np.memmap)
    assert (np.diff(array.keys.astype(object)) > 0).all()
    array.keys = np.full(3, 7, np.uint64)  # every key the same
    stored = [bytes(array.strings[array.ends[i] : array.ends[i + 1]]) for i in range(3)]
    assert array.probe([b"c/d", b"a", b"x", b"b"], digest=lambda _: 7).tolist() == [stored.index(b"c/d"), stored.index(b"a"), -1, stored.index(b"b")]
