from furrow.llm import url_filter


def reference(url):
    """Host, path and rule, step by step."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best and best.verdict


def test_rules_and_learned_verdicts(spark):
    urls = [None, "", "no-scheme.com/a", "http://", "http://A.Example.COM/en/1?x#y", "https://www.example.com/en/2", "http://xexample.com/en/",
            "http://com", "http://com/", "http://a.net/es/", "http://a.net?/es/", "ftp://a.net#/fr/", "http://a.net/fr/q://b.com/", "x://y.org/ü?ä"]
    urls += [f"http://good{i}.example.com/docs/{i}" for i in range(200)] + [f"http://spam{i}.net/fr/win-cash-{i}" for i in range(200)]
    urls += ["http://spam7.org/fr/win-cash-7", "http://good7.org/docs/7"]
    rows = [(i, u, "h", "v") for i, u in enumerate(urls)] + [(None, None, "h", "v")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    model = url_filter.fit(df)
    found = {r.page_id: r for r in url_filter.judge(df, model).collect()}
    assert len(found) == len(rows)
    for i, u in enumerate(urls):
        host, path, rule, verdict = reference(u)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule), u
        assert found[i].verdict == (verdict or found[i].verdict) and found[i].verdict in ("allow", "block")
        assert abs(found[i].score - model.score(u)) < 1e-9
    assert found[len(urls) - 2].verdict == "block" and found[len(urls) - 1].verdict == "allow"
    assert found[0].verdict == found[1].verdict == "block"
    assert url_filter.judge(df.limit(0), url_filter.fit(df.limit(0))).count() == 0


def test_counts_make_a_probability():
    """The bytes after a context share its probability, up to hash collisions."""
    import numpy as np
    import pandas as pd

    table = pd.concat(url_filter._count(iter([pd.DataFrame({"url": ["abcabd", "abce"], "verdict": ["allow", "block"]})])))
    counts = np.zeros((2, 12, 1 << url_filter.BITS), dtype=np.float32)
    counts[table.v, table.k, table.bucket] = table.n
    model = url_filter.Model(counts[:, :6], counts[:, 6:], 0.0)
    total = sum(np.exp(model.log_likelihoods("ab" + chr(c))[0] * 3 - model.log_likelihoods("ab")[0] * 2) for c in range(128))
    assert 0.5 < total <= 1.0 + 1e-6
