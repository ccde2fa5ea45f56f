"""The pipeline's stages against plain versions, and the entry point without the subpackage."""

import os
import re
import subprocess
import sys
from collections import Counter, defaultdict

import corpus_pipeline
from screensift.llm import decontam, mixing, toxicity
from screensift.llm.frames import materialise

from .test_operators import plain_fingerprint, plain_hits, roots

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain_lines(rows):
    """Text of every row without the lines on too many of its source's pages."""
    normal = lambda x: re.sub(r"[ \t\x0b\f\r]+", " ", x).strip(" ").lower()
    pages, on = Counter(r.source for r in rows), Counter()
    for r in rows:
        on.update((r.source, x) for x in {normal(x) for x in r.text.split("\n")} if x)
    drop = {k for k, n in on.items() if n >= 3 and n / pages[k[0]] > 0.01}
    return {r.doc_id: "\n".join(x for x in r.text.split("\n") if (r.source, normal(x)) not in drop) for r in rows}


def test_stages_equal_plain_versions(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    bench = [(r.item_id, r.text) for r in corpus_pipeline.table(spark, SF, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "mixing"]

    judged = toxicity.toxicity(docs, corpus_pipeline.table(spark, SF, "labels")).where("rejected").select("doc_id").collect()
    clean = materialise(stages["toxicity"](spark, docs, SF), "t")
    assert clean.columns == docs.columns
    rows = clean.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()} - {r.doc_id for r in judged}

    lined = materialise(stages["line_dedup"](spark, clean, SF), "t")
    texts = {r.doc_id: r.text for r in lined.collect()}
    assert texts == plain_lines(rows)

    single = materialise(stages["simhash_dedup"](spark, lined, SF), "t")
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    root = roots(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    groups = defaultdict(list)
    for i, r in zip(ids, root):
        groups[r].append(i)
    assert sorted(r.doc_id for r in single.collect()) == sorted(min(g) for g in groups.values())

    free = materialise(stages["decontamination"](spark, single, SF), "t")
    hits = {r.doc_id: plain_hits(r.text, bench) for r in single.collect()}
    left = {r.doc_id: r for r in free.collect()}
    assert set(left) == {i for i, (n, h, _) in hits.items() if not (h and 20 * h >= n)}
    for i, r in left.items():
        n, h, _ = hits[i]
        assert len(decontam.words_of(r.text)) >= n - h and (h or r.text == texts[i]) and r.n_chars == len(r.text)

    mixed = stages["mixing"](spark, free, SF)
    taken = {r.doc_id: r.taken for r in mixing.mix(free).collect()}
    copies = Counter(r.doc_id for r in mixed.collect())
    assert all(copies[i] * len(left[i].text.split()) == t for i, t in taken.items())
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == copies


def test_entry_without_the_subpackage():
    code = ("import sys; sys.modules['screensift.llm'] = None; import __spark_entry__ as e; "
            "assert len(e.queries()) > 80 and not any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in e.queries())")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
