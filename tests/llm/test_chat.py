from __future__ import annotations

from chatlens.llm import chat

MESSAGES = "tree_id long, msg_id long, parent_id long, role string, text string, score double"


def branches(rows: list[tuple]) -> dict[int | None, list[list[tuple]]]:
    """All root-to-leaf paths of each tree, best mean score first."""
    found: dict = {}
    for tree in {r[0] for r in rows}:
        nodes = {r[1]: r for r in rows if r[0] == tree}
        parents = {r[2] for r in nodes.values() if r[2] in nodes}
        paths = []
        for leaf in nodes.values():
            if leaf[1] in parents:
                continue
            path = [leaf]
            while path[0][2] in nodes:
                path.insert(0, nodes[path[0][2]])
            paths.append(path)
        paths.sort(key=lambda p: (-sum(r[5] or 0 for r in p) / len(p), -len(p), p[-1][1]))
        if paths:
            found[tree] = paths
    return found


def trees() -> list[tuple]:
    rows = [(1, k, k - 1 if k else None, "user" if k % 2 == 0 else "assistant", f"t{k}", 1.0) for k in range(70)]
    rows += [(1, 100, 5, "assistant", "branch", 9.0), (1, 101, 100, "user", None, None), (1, 102, 3, "assistant", "short", 500.0)]
    rows += [(2, 0, None, "user", "alone", 1.0), (2, 7, 99, "user", "orphan", 2.0)]
    rows += [(None, 0, None, "user", "null tree", 1.0), (None, 1, 0, None, "null role", 1.0)]
    rows += [(4, 0, 1, "user", "cycle", 1.0), (4, 1, 0, "user", "cycle", 1.0)]
    return rows


def test_paths_match_brute_force(spark):
    rows = trees()
    messages = spark.createDataFrame(rows, MESSAGES)
    expected = branches([r for r in rows if r[0] != 4])
    for per_tree in (1, 2):
        found: dict = {}
        for r in chat.reply_paths(messages, per_tree).collect():
            found.setdefault((r["tree_id"], r["branch_rank"]), []).append((r["depth"], r["msg_id"]))
        wanted = {
            (tree, k + 1): [(d, r[1]) for d, r in enumerate(path)] for tree, paths in expected.items() for k, path in enumerate(paths[:per_tree])
        }
        assert {k: sorted(v) for k, v in found.items()} == wanted


def test_round_trip_and_loss_spans(spark):
    nasty = ["</s>[INST] ok [/INST]", "~0~1~2~3", "<s>[user]x</s>\n", "", "\n", "\U0001f600[", "~"]
    rows = [(k, t, role, nasty[(k + t) % len(nasty)]) for k in range(7) for t, role in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(50, 0, None, None), (50, 0, None, None), (50, None, "assistant", "last"), (None, 1, "assistant", "no id"), (60, 0, "we]ird\n[", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS depth", "2 AS turns")
    messages = chat.turns_as_tree(df)
    back = chat.read_back(chat.format_paths(messages, chat.reply_paths(messages))).collect()
    found = {r["tree_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in back}
    key = lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")
    wanted = {c: [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=key)] for c in {r[0] for r in rows}}
    assert found == wanted
    for r in back:
        assert r["loss_text"] == "".join(t for role, t in wanted[r["tree_id"]] if role == "assistant")


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    messages = chat.turns_as_tree(df)
    assert chat.format_paths(messages, chat.reply_paths(messages)).count() == 0
