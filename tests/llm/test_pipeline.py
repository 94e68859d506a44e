"""The pipeline against its stages done plainly."""

import hashlib

import corpus_pipeline
from scrubline.llm import langid

from ..conftest import SF_SMALL
from . import brute


def mix(rows):
    """rows: (doc_id, source, text), distinct ids -> {doc_id: times taken}"""
    size = {d: len(brute.words(t)) for d, _, t in rows}
    by = {}
    for d, s, _ in rows:
        by.setdefault(s, []).append(d)
    total = {s: sum(size[d] for d in ds) for s, ds in by.items()}
    want = brute.targets(total, {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(by))}, 1.5 * sum(total.values()), 2)
    out = {}
    for s, ds in by.items():
        whole = int(want[s] // total[s]) if total[s] else 0
        left = want[s] - whole * total[s]
        start, picked = 0, set()
        order = sorted(ds, key=lambda d: (hashlib.md5(f"7:{d}".encode()).hexdigest(), d))
        for d in order:
            if size[d] and start + size[d] / 2 <= left:
                picked.add(d)
            start += size[d]
        rest = left - sum(size[d] for d in picked)
        swaps = [(abs(size[d] - abs(rest)), n, d) for n, d in enumerate(order)
                 if size[d] and (d in picked) == (rest < 0) and abs(size[d] - abs(rest)) < abs(rest) and left > 0]
        if swaps:
            picked ^= {min(swaps)[2]}
        out |= {d: whole + (d in picked) for d in ds}
    return out


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    classify = langid.classifier(langid.fit(docs))
    rows = [r for r in rows if not classify(r[2])[2]]
    assert len(rows) >= 0.97 * docs.count()
    groups = brute.components([(d, t) for d, _, t in rows], 80)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    raws = [t.encode() for _, _, t in rows]
    rows = [(d, s, bytes(b for i, b in enumerate(raw) if i not in gone).decode("utf-8", "ignore"))
            for (d, s, _), raw, gone in zip(rows, raws, brute.repeated_windows(raws, 200))]
    times, enc = mix(rows), brute.bpe_encoder()
    want = sorted((d, hashlib.sha256(",".join(map(str, enc.encode_ordinary(t))).encode()).hexdigest()) for d, _, t in rows
                  for _ in range(times[d]))
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in got) == want
    assert all(len(r.token_ids) == r.n_tokens for r in got)


def test_stages_keep_columns_and_take_odd_rows(spark):
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "a", 0), (None, "the cat and the dog " * 40, "en", "a", 5),
                                 (3, "the cat and the dog " * 40, "en", None, 5), (3, "the cat and the dog " * 40, "en", None, 5),
                                 (4, "der hund und die katze " * 400, "de", "b", 5)], ddl)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (odd, odd.limit(0)):
            assert stage(spark, df, SF_SMALL).columns == odd.columns, name
            stage(spark, df, SF_SMALL).collect()
    assert len(corpus_pipeline.STAGES[-1][1](spark, odd, SF_SMALL).collect()) == 6


def test_repeated_rows_leave_one_with_its_text(spark):
    text = {c: " ".join(f"{c}{i}" for i in range(150)) for c in "abcde"}
    rows = [(1, text["a"], "en", "s", 9)] * 3 + [(5, text["a"], "en", "s", 9)]  # a repeated row and a copy of it
    rows += [(2, text["b"], "en", "s", 9), (2, text["b"] + " end", "en", "s", 9)]  # one id, near-equal texts
    rows += [(None, text["c"], "en", "s", 9)] * 3  # no id in the whole group
    rows += [(3, text["d"], "en", "s", 9), (3, text["d"], "de", "t", 9)]  # one document under two sources
    rows += [(4, text["e"], "en", "s", 9), (4, "", "en", "s", 0), (4, "", "en", "s", 0), (6, "", "en", "s", 0), (None, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    near = corpus_pipeline.near_dedup(spark, docs, SF_SMALL)
    got = corpus_pipeline.suffix_dedup(spark, near, SF_SMALL).collect()
    assert near.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in got) == [0, 0, 1, 2, 3, 4, 4, 6]
    left = {c: [r.text.removesuffix(" end") for r in got if r.text and r.text.startswith(c)] for c in text}
    assert left == {c: [t] for c, t in text.items()}
    assert [(r.lang, r.source) for r in got if r.doc_id == 3] == [("de", "t")]
