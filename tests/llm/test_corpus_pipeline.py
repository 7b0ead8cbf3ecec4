"""The pipeline against what its stages must do, on a small corpus."""

import random
import struct

import corpus_pipeline
import public_tokenizers
import tiktoken

from driftwright.llm import bpe


def test_pipeline(spark, tmp_path):
    rng = random.Random(17)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(1500)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = text(30)
    texts = {k: text(60) for k in range(40)}
    texts[50] = texts[3]  # a copy
    texts[51] = texts[4] + " more"  # nearly one
    texts[52] = text(40) + " " + item + " " + text(40)  # contaminated
    texts[53] = text(40) + ' token = "0123456789abcdef0123456789abcdef"'
    texts[54] = "12345 !!"  # no letter
    texts[55] = None
    rows = [(k, t, "aa", f"s{k % 3}", len(t or ""), "x") for k, t in texts.items()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, base string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mask_secrets", "encode"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "base"]
        docs.write.parquet(path := str(tmp_path / _))
        docs = spark.read.parquet(path)
    kept = {r.doc_id: r for r in docs.collect()}
    assert set(kept) == {*range(40), 53} and all(r.base == "x" and r.n_chars == len(r.text) for r in kept.values())
    assert kept[53].text.endswith('<secret>"') and all(kept[k].text == texts[k] for k in range(40))

    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(found) == set(kept)
    for k, r in found.items():
        assert list(struct.unpack(f"<{r.n_tokens}I", bytes(r.ids_le))) == exact.encode_ordinary(kept[k].text)


def test_near_dedup_takes_five_words_and_four_fifths(spark):
    rng = random.Random(23)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(5, 9))) for _ in range(6000)]
    texts: list[str] = []
    for size in (200, 90, 400):
        for more in (0.18, 0.2, 0.22, 0.24, 0.248, 0.26, 0.28):  # appended: similarities on both sides of 0.8
            base = rng.sample(words, size)
            texts += [" ".join(base), " ".join(base + rng.sample(words, round(size * more)))]
        base = rng.sample(words, size)  # changed here and there
        texts += [" ".join(rng.choice(words) if rng.random() < rate else w for w in base) for rate in (0, 0.01, 0.015, 0.02, 0.025, 0.03)]
    texts += ["one two three four", "one two three four", "one two three"]
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))})
    group = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert {r.doc_id for r in kept.collect()} == set(group) and len(set(group)) < len(texts) - 10
