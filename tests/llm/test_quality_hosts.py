"""Host verdicts at the registered limits, against the formulas in plain Python."""

import random

from ferryline.llm import quality

VOCABULARY = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in "lnrst"]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


LIMITS = quality.QualityLimits()


def corpus():
    """Twenty hosts where one document in twenty is short, and one where two in five
    are; a host of three documents that all fail by chance of few."""
    rng, rows = random.Random(4), []
    for host in range(20):
        for k in range(80):
            short = rng.random() < (0.4 if host == 13 else 0.05)
            rows.append((len(rows), prose(20 if short else 70, len(rows)), f"h{host}"))
    rows += [(len(rows) + k, prose(20, k), "tiny") for k in range(3)]
    rows += [(len(rows) + k, prose(90, k), "tiny") for k in range(9)]
    rows.append((len(rows), prose(90, 1), None))
    return rows


def test_a_planted_host_is_found(spark):
    rows = corpus()
    found = {r["doc_id"]: r for r in quality.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for i, text, host in rows:
        short = len(text.split()) < LIMITS.min_words
        assert found[i]["base_failed"] == short
        assert found[i]["host_ok"] == (host != "h13"), host
        assert found[i]["kept"] == (not short and host != "h13")


def test_rates_are_shrunk_towards_the_corpus(spark):
    rows = corpus()
    measured = quality.document_measures(
        spark.createDataFrame(rows, "doc_id long, text string, source string"),
        ["doc_id", "source"])
    rates = {r["source"]: r for r in quality.host_rates(measured, "source", LIMITS).collect()}
    hosts = {}
    for _, text, host in rows:
        if host is not None:
            n, k = hosts.get(host, (0, 0))
            hosts[host] = n + 1, k + (len(text.split()) < LIMITS.min_words)
    docs, failed = (sum(v[j] for v in hosts.values()) for j in (0, 1))
    a, b = quality.beta_prior(len(hosts), docs, failed, sum(n * n for n, _ in hosts.values()),
                              sum(k * k / n for n, k in hosts.values()))
    for host, (n, k) in hosts.items():
        assert abs(rates[host]["short_rate"] - (k + a) / (n + a + b)) < 1e-9
    # Few documents say little: the small host's rate moves most of the way.
    assert rates["tiny"]["short_rate"] < 0.2 < 3 / 12
