import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from shelftide.llm import decontam, line_dedup, oracle as sql, packing
from shelftide.llm.shared import stored

from . import cases
from .test_decontam import ITEMS, brute
from .test_packing import check_placed
from .test_simhash import brute_components, brute_fingerprint


def plain_lines(rows):
    """Texts without all but the first copy of lines on many sites."""
    sites, first = defaultdict(set), {}
    for d, t, s in rows:
        for k, line in enumerate((t or "").split("\n")):
            if key := line.strip(" \t\n\r\x0b\x0c"):
                sites[key].add(s or "")
                first[key] = min(first.get(key, (d, k)), (d, k))
    out = {}
    for d, t, _ in rows:
        lines = enumerate((t or "").split("\n"))
        keep = [x for k, x in lines if len(sites[x.strip(" \t\n\r\x0b\x0c")]) < line_dedup.MIN_SITES or first[x.strip(" \t\n\r\x0b\x0c")] == (d, k)]
        out[d] = "\n".join(keep)
    return out


def test_run_equals_plain_stages(spark, sf_dir):
    from checks.compare import connect

    con = connect(sf_dir)
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({sql.ORACLE['op6_quality_rules']}) WHERE kept").fetchall()}
    rows = [r for r in con.execute("SELECT doc_id, text, source FROM documents").fetchall() if r[0] in kept]
    texts = plain_lines(rows)
    prints = [(d, brute_fingerprint(t)) for d, t in texts.items()]
    component = brute_components(prints, 4)
    texts = {d: texts[d] for d, f in prints if component[d, f] == d}
    items = [decontam.words_of(t) for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
    texts = {d: t for d, t in texts.items() if not any(brute(i, decontam.words_of(t))[0] <= decontam.most_edits(len(i)) for i in items)}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = []
    for d, t in texts.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want += [(d, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(packing.cut_points(len(ids)))]
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    check_placed(got)


def test_stages_on_edges(spark, tmp_path):
    spark.createDataFrame([(1, "zebra crossing ahead")], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (cases.docs(spark), cases.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, str(tmp_path)))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == cases.DOCS.names and out.count() <= docs.count()
                docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
