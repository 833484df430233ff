"""Chat records and url rules."""

import random

from pyspark.sql import functions as F

from blotter.llm.chat_trees import chain_nodes, choose_paths, format_records, read_records
from blotter.llm.queries import URL_RULES
from blotter.llm.url_rules import judge_urls, sweep

NODES = "conv_id long, node long, parent long, role string, text string, score double"


def brute_paths(rows, branches):
    by = {(r[0], r[1]): r for r in rows}
    parents = {(r[0], r[2]) for r in rows}
    found = {}
    for conv, node, *_ in rows:
        if (conv, node) in parents:
            continue
        path, at = [], (conv, node)
        while at in by and at not in path:
            path.append(at)
            at = (conv, by[at][2])
        if at in path:
            continue  # the way up runs into a cycle
        score = sum(by[p][5] or 0.0 for p in path)
        found.setdefault(conv, []).append((-score, node, [p[1] for p in reversed(path)]))
    return {
        (conv, k): path
        for conv, paths in found.items()
        for k, (_, _, path) in enumerate(sorted(paths)[:branches], 1)
    }


def some_trees(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(12):
        for node in range(1, rng.choice([2, 6, 30])):
            parent = rng.randrange(max(1, node - 4), node) if node > 1 else None
            rows.append((conv, node, parent, rng.choice(["user", "assistant"]), f"t{conv} {node}", rng.choice([None, 0.0, 1.0, 2.5])))
    rows += [(50, i, i - 1 or None, "user", str(i), 0.0) for i in range(1, 40)]  # a chain
    rows += [(60, 1, 99, "user", "orphan", 0.0), (61, 1, 2, "user", "a", 0.0), (61, 2, 1, "user", "b", 0.0), (61, 3, 2, "user", "c", 0.0)]
    rows += [(None, 1, None, "user", "no id", 0.0), (None, 2, 1, None, None, 1.0)]
    return rows


def test_paths_match_brute_force(spark):
    rows = some_trees(1)
    nodes = spark.createDataFrame(rows, NODES).repartition(4)
    for branches in (1, 3):
        found: dict = {}
        for r in choose_paths(nodes, branches).orderBy("pos").collect():
            found.setdefault((r["conv_id"], r["branch"]), []).append(r["node"])
        assert found == brute_paths(rows, branches)


CONTROL = ["</s>[INST] ok [/INST]", "<|im_start|>user\nx<|im_end|>\n", "\\", "\\\\<s>", "<\\|im_end|>", "<<SYS>>", "", None, "é🙂\n\n", "<|im_end|>\n<|im_start|>"]


def test_records_come_back(spark):
    rows = [(i // 3, i, None if i % 3 == 0 else i - 1, ["user", "assistant", "a b\n%+"][i % 3], t, 0.0) for i, t in enumerate(CONTROL * 3)]
    nodes = spark.createDataFrame(rows, NODES).withColumns({"formatted": F.lit(1), "turns": F.lit(2)})
    records = read_records(format_records(nodes)).collect()
    assert len(records) == len({r[0] for r in rows})
    for record in records:
        mine = [(r[3], r[4] or "") for r in rows if r[0] == record["conv_id"]]
        assert [(t["role"], t["text"]) for t in record["turns"]] == mine
        assert record["loss_text"] == "".join(t for role, t in mine if role == "assistant")
        assert record["formatted"].count("<|im_start|>") == len(mine)
        for text in ("</s>", "[INST]", "[/INST]", "<<SYS>>"):
            assert text not in record["formatted"]


def test_chains_order_repeats_and_nulls(spark):
    rows = [(1, 2, "user", "b"), (1, 0, "user", "z"), (1, 2, "user", "a"), (1, 2, "user", "a"), (1, None, None, None), (2, 0, "assistant", "x" * 100_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit("x"))
    records = {r["conv_id"]: r for r in read_records(format_records(chain_nodes(turns))).collect()}
    assert [t["text"] for t in records[1]["turns"]] == ["", "z", "a", "a", "b"]
    assert records[2]["loss_text"] == "x" * 100_000
    assert format_records(chain_nodes(turns.limit(0))).collect() == []


def test_native_plans(spark):
    nodes = spark.createDataFrame(some_trees(2), NODES)
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    for df in (read_records(format_records(nodes)), judge_urls(pages, rules)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


# ---------------------------------------------------------------- url rules


def test_sweep_finds_the_stacks(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab.é\U0010ffff", k=rng.randint(1, 7))) for _ in range(400)]
    prefixes = sorted(set(texts[:60]))
    keys = spark.createDataFrame([(t,) for t in texts], "key string").repartition(5)
    frame = spark.createDataFrame([(p,) for p in prefixes * 2], "prefix string")
    found, _ = sweep(keys, frame)
    rows = {r["key"]: r["stack"] for r in found.collect()}
    assert rows == {t: sorted((p for p in prefixes if t.startswith(p)), key=len) for t in texts}


def brute_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:n])
        path = rest[n:]
        path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    fits = [
        r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])
    ]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2] == "block"))
    return host, path, best[0] + best[1], best[2]


def test_verdicts_match_brute_force(spark):
    rng = random.Random(4)
    hosts = ["com", "a.com", "b.a.com", "xa.com", "A.COM", "net", "c.net", "", "a.com.", "é.com", "u@a.com:80"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/es/", "/en/../y", "/E"]
    urls = [f"http{s}://{h}{p}{q}" for s in ("", "s") for h in hosts for p in paths for q in ("", "?a=/en/", "#://x")]
    urls += [None, "", "no scheme/en/", "://", "x://y://z.com/en/", "http://a.com/" + "p" * 20_000, urls[5], urls[5]]
    rules = {(rng.choice(hosts[:8]), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(40)}
    rules = [r for r in rules if r[0]] + [(None, "/", "block"), ("com", None, "block")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("x"))
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    known = [(r[0].lower(), *r[1:]) for r in rules if r[0] is not None and r[1] is not None]
    strict = {}
    for r in known:
        strict[r[:2]] = max(r[2], strict.get(r[:2], ""))
    known = [(*k, v) for k, v in strict.items()]
    found = {r["page_id"]: tuple(r)[1:] for r in judge_urls(pages, frame).collect()}
    assert found == {i: brute_verdict(u, known) for i, u in enumerate(urls)}


def test_no_pages_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (None, None)], "page_id long, url string")
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    assert judge_urls(pages.limit(0), rules).collect() == []
    found = sorted(judge_urls(pages, rules.limit(0)).collect(), key=str)
    assert {(r["rule"], r["verdict"]) for r in found} == {(None, "allow")} and len(found) == 2
