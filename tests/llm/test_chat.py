import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from freshet.llm import chat, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TURNS = "conv_id long, turn long, role string, text string"


@given(st.text(alphabet="\\<l>n/turn \n[]a\x00é"), st.text(alphabet="\\<l>n/turn \n[]a"))
def test_escaping_is_reversible(role, text):
    segment = chat.format_turn(role, text)
    assert chat.parse_turn(segment) == (role, text)
    assert segment.count(chat.OPEN) == 1 and segment.count(chat.CLOSE.strip()) == 1


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(4)
    rows = []
    for conv in range(120):
        text = "system prompt" if conv % 3 == 0 else f"hello {conv % 7}"
        rows.append((conv, 0, "system" if conv % 3 == 0 else "user", text))
        for turn in range(1, 1 + rng.randrange(5)):
            rows.append((conv, turn, "assistant" if turn % 2 else "user", rng.choice(["yes", "no </turn>", "<turn>user\nno\\", "é漢 "])))
    rows += [(500, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(300)]
    rows += [(600 + c, t, "user", "copy") for c in range(40) for t in range(3)]
    rows += [(None, 0, "user", None), (None, 1, None, ""), (700, None, "assistant", "x"), (700, 1, "assistant", "b"), (700, 1, "assistant", "a"), (700, 1, "assistant", "a")]
    rows += [(701, 0, "user", "long " * 30_000)]
    return rows


@pytest.fixture(scope="module")
def tree(spark, conversations):
    frame = spark.createDataFrame(conversations, TURNS).repartition(3).withColumn("node", F.lit("clash")).withColumn("rank", F.lit(1))
    return chat.prefix_tree(frame, PATH)


def grouped(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    return {conv: [(t[3], t[5]) for t in sorted(turns)] for conv, turns in convs.items()}


def test_read_back(tree, conversations):
    got = {r["conv_id"]: r for r in chat.read_back(*tree, PATH).collect()}
    want = grouped(conversations)
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        formatted = "".join(chat.format_turn(*t) for t in turns)
        r = got[conv]
        assert r["n_turns"] == len(turns) and r["formatted_chars"] == len(formatted) and r["loss_chars"] == len(loss)
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()


def test_layout(tree, conversations):
    """Nodes tile the layout depth first, ancestors spell the prefix, positions are its length."""
    nodes = {r["node"]: r for r in tree[0].collect()}
    ordered = sorted(nodes.values(), key=lambda r: r["start"])
    at, path, layout = 0, [], []
    for r in ordered:
        assert r["start"] == at and r["size"] == len(r["tokens"])
        while path and path[-1] != r["parent"]:
            path.pop()
        assert path or r["parent"] is None
        path.append(r["node"])
        layout += r["tokens"]
        at += r["size"]
    distinct = set()
    for turns in grouped(conversations).values():
        distinct.update(tuple(turns[: i + 1]) for i in range(len(turns)))
    assert len(nodes) == len(distinct)
    tokenizer = Tokenizer.from_file(PATH)
    for r in ordered[:400]:
        prefix, node = [], r
        while node["parent"] is not None:
            node = nodes[node["parent"]]
            prefix = [*node["tokens"], *prefix]
        spelled = [t for i in r["ancestors"] for t in layout[i["start"] : i["end"]]]
        assert spelled == prefix and r["position"] == len(prefix) and r["tree"] == node["start"]
        role, text = chat.parse_turn(tokenizer.decode(r["tokens"], skip_special_tokens=False))
        masked = tokenizer.decode(r["tokens"][r["loss_start"] : r["loss_end"]], skip_special_tokens=False)
        assert chat.unescape(masked) == (text if role == "assistant" else "")
        ends = [i["end"] for i in r["ancestors"]]
        assert all(a < b["start"] for a, b in zip(ends, r["ancestors"][1:], strict=False))


def test_sort_keys_do_not_grow_with_shared_turns(spark, monkeypatch):
    """Two conversations that share 20,000 turns and then part: their keys have one name each, and one more."""
    keys = []
    plain = chat.materialized

    def materialized(frame, name):
        out = plain(frame, name)
        if name == "paths":
            keys.extend(r["path"] for r in out.collect())
        return out

    monkeypatch.setattr(chat, "materialized", materialized)
    many = spark.range(20_000).select(F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    two = many.crossJoin(spark.createDataFrame([(1,), (2,)], "conv_id long"))
    last = spark.createDataFrame([(1, 30_000, "user", "one"), (2, 30_000, "user", "two"), (3, 0, "user", "t0"), (3, 1, "user", "t1"), (4, 0, "user", "alone")], TURNS)
    nodes, places = chat.prefix_tree(two.select("conv_id", "turn", "role", "text").unionByName(last), PATH)
    assert max(map(len, keys)) == 64 and len(keys) == 4
    assert nodes.count() == 20_000 + 3 and places.count() == 40_005
    rows = nodes.orderBy("start").select("start", "size").collect()
    assert all(a["start"] + a["size"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))
    got = {r["conv_id"]: r for r in chat.read_back(nodes, places, PATH).collect()}
    text = "".join(f"user\nt{i}\n" for i in range(20_000))
    assert got[1]["turns_sha256"] == hashlib.sha256((text + "user\none\n").encode()).hexdigest() and got[2]["n_turns"] == 20_001


def test_decoding_by_table_is_the_tokenizers(spark):
    decode, tokenizer = packing.decoder(PATH), Tokenizer.from_file(PATH)
    for text in ("", "plain words", "né 漢字 \n\t <turn>", "<|endoftext|> x", "".join(map(chr, range(1, 700)))):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert decode(ids) == text == tokenizer.decode(ids, skip_special_tokens=False)


def test_no_conversations(spark):
    nodes, places = chat.prefix_tree(spark.createDataFrame([], TURNS), PATH)
    assert nodes.count() == 0 and chat.read_back(nodes, places, PATH).count() == 0
