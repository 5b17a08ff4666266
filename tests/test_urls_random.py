"""Randomised URL checks: thousands of generated cases in one Spark job each."""

import random
from urllib.parse import urljoin, urlsplit

from pyspark.sql import functions as F

from webloom.functions import urls as U

TOKENS = ["a", "b", "x.html", ".", "..", "", "%20", "ü", ";p", "~u", "a:b", "@", "?", "#", "//", "/", "q=1",
          "www.", "HTTP", "https:", "http:", "mailto:", " ", "\t", "index.php", "a b", "#f", "?x=/y/"]
HOSTS = ["h.com", "www.h.com", "H.Com", "h.com:8080", "u@h.com", "h.com:80", "h.com:443", "[::1]", "h.com:"]


def rand_href(r):
    n = r.randint(0, 6)
    s = "".join(r.choice(TOKENS) + (r.choice(["/", ""])) for _ in range(n))
    lead = r.choice(["", "", "/", "//", "./", "../", "?", "#", "http://" + r.choice(HOSTS) + "/",
                     "https://" + r.choice(HOSTS)])
    return lead + s


def rand_base(r):
    path = "/" + "/".join(r.choice(["a", "b", "c", "", "d.html", ".."]) for _ in range(r.randint(0, 4)))
    q = r.choice(["", "?q=1", "?", "?a=/b"])
    f = r.choice(["", "#x", "#"])
    return r.choice(["http", "https"]) + "://" + r.choice(HOSTS) + r.choice([path, ""]) + q + f


def test_resolve_random_against_urljoin(spark):
    r = random.Random(7)
    pairs = [(rand_base(r), rand_href(r)) for _ in range(3000)]
    df = spark.createDataFrame(pairs, "b string, h string")
    got = df.select("b", "h", U.resolve_url(F.col("b"), F.col("h")).alias("r")).collect()
    bad = [(x.b, x.h, x.r, urljoin(x.b, x.h)) for x in got if x.r != urljoin(x.b, x.h)]
    assert not bad, bad[:8]


def test_normalize_random_and_idempotent(spark):
    r = random.Random(11)
    urls = []
    for _ in range(3000):
        u = rand_base(r) if r.random() < 0.7 else rand_href(r)
        if r.random() < 0.3:
            u = u.split("://", 1)[-1]
        if r.random() < 0.2:
            u = "  " + u + "/ "
        urls.append((u,))
    df = spark.createDataFrame(urls, "u string")
    n1 = df.select("u", U.normalize_url(F.col("u")).alias("n"))
    got = n1.select("u", "n", U.normalize_url(F.col("n")).alias("nn")).collect()
    for x in got:
        if x.n is None:         # the contract: a URL with a bad port gives null
            continue
        given = x.u.strip()
        given = given if given.startswith(("http://", "https://")) else "https://" + given
        try:
            old, new = urlsplit(given), urlsplit(x.n)
        except ValueError:
            continue
        if not old.hostname:    # nothing to keep
            continue
        # scheme, host and query stay; a default port and slashes at the end go
        assert (old.scheme, old.hostname, old.query) == (new.scheme, new.hostname, new.query), (x.u, x.n)
        assert (new.scheme, new.port) not in (("http", 80), ("https", 443)), (x.u, x.n)
        if new.netloc and ";" not in given:
            assert new.path == "/" or not new.path.endswith("/") or not new.path.strip("/"), (x.u, x.n)
        # normalising twice equals once unless the path is all slashes
        rest = x.n.split("://", 1)[-1] if x.n is not None else ""
        has_host = rest[:1] not in ("", "/", "?", "#")
        head = rest.split("?", 1)[0].split("#", 1)[0]
        if x.n is not None and x.n == x.n.strip() and has_host and "/" in head and ";" not in rest and "//" not in rest \
                and rest.split("/", 1)[-1].strip("/") != "":
            assert x.nn == x.n, (x.u, x.n, x.nn)
