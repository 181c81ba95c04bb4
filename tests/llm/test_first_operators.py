"""Exact dedup, packing, toxicity, chat formatting and sharding against plain versions of themselves."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.llm import chat, common, exact_dedup, packing, sharding, templates, toxicity

ODD_DOCS = "doc_id long, text string, lang string, source string, n_chars long, sha string, id long, norm string"


def odd_docs(spark, texts):
    """Documents with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, None, None, None, "x", 5, None) for i, t in texts], ODD_DOCS)


TEXTS = [(1, "A b"), (2, "a B"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "a b"), (7, "a b"), (8, "word " * 30000), (None, "É"), (None, "zz"), (9, "A B ")]


def groups_by_hand(texts, keep):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    by = defaultdict(list)
    for i, t in texts:
        by[lower(t)].append(i)
    best = lambda ids: (min if keep == "smallest" else max)((i for i in ids if i is not None), default=None)
    return Counter((i, best(by[lower(t)]), len(by[lower(t)]), i == best(by[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in texts)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_exact_groups(spark, keep, digest_bytes):
    texts = TEXTS + [(100 + i, f"text {i % 70}") for i in range(300)] * (digest_bytes == 1)
    found = exact_dedup.exact_groups(odd_docs(spark, texts), keep, digest_bytes=digest_bytes).collect()
    assert Counter(tuple(r) for r in found) == groups_by_hand(texts, keep)


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.exact_groups(odd_docs(spark, [])).count() == 0


def test_index_takes_batches(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"))
    index.flush(odd_docs(spark, [(3, "x"), (4, "y")]))
    index.compact()
    index.flush(odd_docs(spark, [(1, "X"), (5, "z")]))
    index.compact()
    assert {(r["id"], r["keep_id"], r["group_size"]) for r in index.resolve("smallest").collect()} == {(3, 1, 2), (1, 1, 2), (4, 4, 1), (5, 5, 1)}
    assert {tuple(r) for r in index.seen(odd_docs(spark, [(8, "X"), (9, "none"), (10, "z")])).collect()} == {(8, 1, 3, 2), (10, 5, 5, 1)}


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_many_runs_and_levels(spark, tmp_path, keep):
    """Memtables of 20 rows, merged by threes, against one group-by."""
    texts = [(i, f"text {i * i % 101}") for i in range(600)]
    docs = odd_docs(spark, texts).repartition(7)
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), memtable_rows=20, fanout=3)
    index.flush(docs.filter("doc_id < 400"))
    files = len(spark.read.parquet(index.flushed[0]).inputFiles())
    index.compact()
    index.flush(docs.filter("doc_id >= 400"))
    assert files >= 20 and index.written >= 5
    merged = index.compact()
    assert merged.count() == merged.select("digest").distinct().count() == len({t for _, t in texts}) and len(index.levels) == 1
    found = exact_dedup.exact_groups(docs, keep, memtable_rows=20, fanout=3).collect()
    assert Counter(tuple(r) for r in found) == groups_by_hand(texts, keep)


def test_steps_delete_their_files(spark):
    """What is written down inside a block goes at its end; its result, and what an outer block has, stay."""
    there = lambda df: spark._jvm.org.apache.hadoop.fs.Path(common._file(df)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(common._file(df)))
    with common.steps(spark):
        outer = common.cut(spark.range(9))
        with common.steps(spark) as result:
            first, second = common.cut(outer.filter("id > 1")), common.cut(outer.filter("id > 2"))
            common.discard(first)
            assert not there(first) and there(second)
            kept = result(second.filter("id > 4"))
        assert not there(second) and there(outer) and kept.count() == 4
    assert not there(outer) and not there(kept)


def test_filters_lose_nothing(spark):
    rows = spark.range(20000).withColumn("k", F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), "id")))
    wanted = rows.filter("id % 500 = 0").select("k")
    found = {r["id"] for r in common.sieve(rows, "k", wanted, "k").collect()}
    assert set(range(0, 20000, 500)) <= found and len(found) < 6000
    assert common.sieve(rows, "k", wanted.limit(0), "k").count() == 0


def check_packing(texts, rows, window=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json"))
    expected = Counter()
    for i, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        expected[(i, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))] += 1
    ids_of = {(i, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)), len(ids)): ids for i, t in texts for ids in [tokenizer.encode(t or "", add_special_tokens=False).ids + [1]]}
    covered = Counter()
    by_doc = defaultdict(list)
    for key in ids_of:
        by_doc[(key[0], key[2])].append(ids_of[key])
    for r in rows:
        matches = [ids for ids in by_doc[(r["doc_id"], r["doc_tokens"])] if zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[r["start"] : r["start"] + r["length"]])) == r["ids_crc32"]]
        assert matches
        covered[(r["doc_id"], r["doc_tokens"])] += r["length"]
    for (i, n), total in covered.items():
        assert total == n * sum(c for (j, m, _), c in expected.items() if (j, m) == (i, n))
    assert sum(covered.values()) == sum(n * c for (_, n, _), c in expected.items())
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, sum(covered.values())


def test_packing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    padding, total = check_packing(texts, packing.pack(docs).collect())
    assert padding < 0.03 * total


def test_packing_odd_rows(spark):
    texts = [*TEXTS, (20, " a  b\n c\t d "), (21, "x\n\ny z"), (22, "<|endoftext|> it's  2 3   b"), (23, " ")]
    check_packing(texts, packing.pack(odd_docs(spark, texts)).collect())
    assert packing.pack(odd_docs(spark, [])).count() == 0


def test_ids_of_odd_texts():
    import random

    from tokenizers import Tokenizer

    tokenizer, encoder, rng = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json")), packing.Encoder(), random.Random(6)
    parts = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "\t", "a", "word", "it's", "2", "é", "日本", "\u3000", ".", "ﬁ", "\u0301", "🙂"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))) for _ in range(4000)]
    for low in range(0, len(texts), 100):
        for t, found in zip(texts[low : low + 100], encoder.encode(texts[low : low + 100]), strict=True):
            assert [int.from_bytes(found[i : i + 2], "little") for i in range(0, len(found), 2)] == tokenizer.encode(t, add_special_tokens=False).ids


def test_plan_uses_each_piece_once():
    import random

    rng = random.Random(3)
    counts = {rng.randrange(1, 1025): rng.randrange(1, 400) for _ in range(900)}
    steps = packing.plan(counts)
    used = Counter()
    for combo, times in steps:
        assert sum(combo) <= 2048 and times > 0
        for a in combo:
            used[a] += times
    assert used == counts
    tokens = sum(a * n for a, n in counts.items())
    assert sum(t for _, t in steps) * 2048 < 1.01 * tokens


def test_toxicity_held_out(spark):
    rows = toxicity.op5_toxicity(spark, "/root/testdata/sf0.1").filter("held_out").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    caught = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    print(right / len(rows), sum(caught) / len(caught), sum(clean) / len(clean))
    assert right >= 0.97 * len(rows) and sum(caught) >= 0.9 * len(caught) and sum(clean) <= 0.01 * len(clean)


def test_toxicity_odd_rows(spark):
    docs = odd_docs(spark, TEXTS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    machine = toxicity.train(docs, none)
    scores = [r["s"] for r in docs.select(toxicity.score_column(machine, F.col("text")).alias("s")).collect()]
    assert scores == [0.25] * len(TEXTS)
    some = spark.createDataFrame([(1, 1), (3, 0), (3, None), (None, 1), (77, 0)], "doc_id long, toxic int")
    assert 0 < toxicity.train(docs, some).bias + 100
    assert docs.limit(0).select(toxicity.score_column(machine, F.col("text")).alias("s")).count() == 0


def test_rare_terms_count(spark):
    """A term of one in a hundred toxic documents and of no clean one, none of which is in the sample's other half."""
    import random

    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = [(i, " ".join([word() for _ in range(30)] + (["grobnak"] if i % 200 == 1 else ["common"] if i % 2 else []))) for i in range(4000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, toxic int")
    machine = toxicity.train(odd_docs(spark, texts), labels)
    plain = " ".join(word() for _ in range(30))
    scorer = toxicity.Scorer(machine)
    assert scorer.score(plain + " grobnak") > 0.9 > 0.5 > scorer.score(plain)


def test_longest_texts_are_learnt_from_within_bounds(spark):
    texts = [(i, " ".join(f"t{i % 2}x{j}" for j in range(3000))) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    machine = toxicity.train(odd_docs(spark, texts), labels, entries=2000)
    assert 0 < len(machine.index) <= 200 and toxicity.Scorer(machine).score(texts[1][1]) > 0.5 > toxicity.Scorer(machine).score(texts[0][1])


def test_machine_learns_an_interaction():
    """Two slots that mean something only together."""
    both, docs, labels = [0, 1], [], []
    for i in range(2000):
        kind = i % 4
        docs.append(sorted({0: [5], 1: [0], 2: [1], 3: both}[kind] + [100 + i % 7]))
        labels.append(int(kind == 3))
    m = toxicity.fit(docs, labels, 0.25, epochs=30)
    at = lambda slots: m.logit(__import__("numpy").array([m.index[s] for s in slots if s in m.index], dtype=int))
    assert at(both) > 0 > max(at([0]), at([1]), at([]))


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "<|im_end|>"), (1, 1, "assistant", "<\\|x <\\\\| <| |"), (1, 1, "assistant", "<\\|x <\\\\| <| |"), (2, None, None, None), (2, 3, "a\nb\\n<|", "x" * 100000), (None, 0, "assistant", "a"), (None, 1, "assistant", ""), (3, 2, "assistant", "é <|im_start|>\n<|im_end|>\n"), (3, 1, "system", "")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append(((t is not None, t or 0, role is not None, role or "", text or ""), role or "", text or ""))
    expected = set()
    for c, turns in by.items():
        turns.sort()
        said = "".join(x[2] for x in turns if x[1] == "assistant")
        expected.add((c, len(turns), hashlib.sha256("".join(f"{x[1]}\n{x[2]}\n" for x in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest()))
    for segment in (1, 2, 256):
        made = chat.format_conversations(frame, segment=segment)
        assert {tuple(r)[:5] for r in chat.read_back(made).collect()} == expected
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0


def test_templates():
    render = lambda s, **names: templates.Template(s).render(**names)
    assert render("a{{ 'b' + 'c' }}{{ 1 + 2 }}")[0] == "abc3"
    assert templates.Template("a{{ 'b' ~ 1 }}{% if true %}c{% else %}{{ x }}{% endif %}").tree == (templates.Text("ab1c"),)
    assert render("{% for m in ms -%}  {% if m.a == 1 %}[{{ m['b']|upper }}]{% elif m.a in [] %}{% endif %}{% endfor %}".replace(" in []", " == 3"), ms=[{"a": 1, "b": "x"}, {"a": 2}])[0] == "[X]"
    assert render("x{% generation %}yy{% endgeneration %}z{# no #}{% generation %}{% endgeneration %}") == ("xyyz", [(1, 3)])
    assert render("{% set a = 2 %}{{ a - 1 }}{{ not a }}{{ none }}")[0] == "1false"
    for bad in ("{% for x in y %}", "{{ x.__class__ }}{{ 1 1 }}", "{% if %}", "{{ f() }}", "{{ x|open }}", "{% end %}"):
        with pytest.raises(templates.TemplateError):
            render(bad, x="s", y=[], f=print)
    with pytest.raises(templates.TemplateError):
        render("{{ x.real }}", x=3)


def check_sharding(texts, rows, shards=8):
    assert Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts) == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    counts = [len(by[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())


def cut_groups(rows):
    """Groups of equal texts in several shards, and how many there are."""
    by = defaultdict(set)
    n = Counter((r["size"], r["text_crc32"]) for r in rows)
    for r in rows:
        by[(r["size"], r["text_crc32"])].add(r["shard"])
    return sum(len(by[k]) > 1 for k in n if n[k] > 1), sum(n[k] > 1 for k in n)


def test_sharding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.op7_sharding(spark, "/root/testdata/sf0.01").collect()
    check_sharding([(r["doc_id"], r["text"]) for r in docs.collect()], rows)
    split, groups = cut_groups(rows)
    print(split, groups)
    assert split <= 0.05 * groups


def test_sharding_hot_group(spark, tmp_path):
    texts = [*TEXTS, *((1000 + i, "hot") for i in range(300)), *((2000 + i, f"pair {i // 2}") for i in range(200)), *((3000 + i, f"one {i}") for i in range(400))]
    odd_docs(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = sharding.op7_sharding(spark, str(tmp_path)).collect()
    check_sharding(texts, rows)
    split, groups = cut_groups(rows)
    print(split, groups)
    assert split <= 8


def test_sharding_all_rows_have_copies(spark, tmp_path):
    texts = [(i, f"pair {i // 2}") for i in range(4000)]
    odd_docs(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = sharding.op7_sharding(spark, str(tmp_path)).collect()
    check_sharding(texts, rows)
    split, groups = cut_groups(rows)
    print(split, groups)
    assert groups == 2000 and split <= 0.1 * groups


def test_sharding_of_nothing(spark, tmp_path):
    odd_docs(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert sharding.op7_sharding(spark, str(tmp_path)).count() == 0
