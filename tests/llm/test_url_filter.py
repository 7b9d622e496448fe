"""The whole verdict of every url, rules and model, against plain loops."""

import math
import zlib

import pytest

from proxylens.llm import url_filter


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]


def plain_rule(host, path):
    best = None
    for rule, verdict in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")):
        domain, rest = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best or (None, None)


def plain_slots(host, path):
    return {zlib.crc32(mark + text[i : i + n]) % (1 << 14) for mark, text in ((b"h", f"^{host}$".encode()), (b"p", f"^{path}$".encode())) for n in (3, 4, 5) for i in range(len(text) - n + 1)}


def plain_model(rows):
    """Gradient steps with adaptive rates, one weight at a time."""
    weights, bias, seen, seen_bias = {}, 0.0, {}, 1e-8
    features = [(sorted(plain_slots(h, p)), y) for (h, p), y in rows.items()]
    used = sorted({s for f, _ in features for s in f})
    for _ in range(300):
        slope, total = dict.fromkeys(used, 0.0), 0.0
        for f, y in features:
            scale = 1 / math.sqrt(max(len(f), 1))
            z = sum(weights.get(s, 0.0) for s in f) * scale + bias
            error = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y
            total += error / len(features)
            for s in f:
                slope[s] += error * scale / len(features)
        seen_bias += total**2
        for s in used:
            g = slope[s] + 1e-4 * weights.get(s, 0.0)
            seen[s] = seen.get(s, 1e-8) + g * g
            weights[s] = weights.get(s, 0.0) - 0.5 * g / math.sqrt(seen[s])
        bias -= 0.5 * total / math.sqrt(seen_bias)
    return weights, bias


def test_verdicts_equal_plain_loops(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url")
    odd = [(10_001, None), (10_002, "no scheme"), (10_003, "HTTP://A.Example.NET/en/x?y#z"), (10_004, "x://net"), (10_005, "x://"), (10_006, "http://w.example.org#frag/fr/"), (10_007, "http://é.org/fr/ü")]
    pages = pages.limit(60).union(spark.createDataFrame(odd, "page_id long, url string"))
    rows = {r.page_id: r.url for r in pages.collect()}
    parts = {i: plain_parts(u) for i, u in rows.items()}
    taught = {parts[i]: float(plain_rule(*parts[i])[1] == "block") for i in rows if plain_rule(*parts[i])[1]}
    weights, bias = plain_model(taught)
    got = {r.page_id: r for r in url_filter.filter_urls(pages).collect()}
    assert got.keys() == rows.keys()
    by_model = 0
    for i, r in got.items():
        rule, verdict = plain_rule(*parts[i])
        slots = plain_slots(*parts[i])
        score = sum(weights.get(s, 0.0) for s in slots) / math.sqrt(max(len(slots), 1)) + bias
        assert (r.host, r.path, r.rule) == (*parts[i], rule)
        assert r.score == pytest.approx(score, abs=1e-6)
        by_model += verdict is None
        assert r.verdict == (verdict or ("block" if score >= 0 else "allow"))
    assert by_model > 10
