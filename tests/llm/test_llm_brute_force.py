"""Scores of the trained operators against their definitions, text by text in plain Python."""

import math
import re
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from llm_data import LONG, MESSY, docs_of, prose

from tillroll.llm import pitman_yor, quality_fm, toxicity
from tillroll.llm.words import ALPHANUMERIC, NOT_SPACE, remainder, words_of
from tillroll.operators.staging import Staging

ODD = ["Two words!\nTwo words!\n\nünd. so\tweiter", "$$ ## 12 AB ab.", "a", "!!", "one. one? one\none!", "漢字 vile oaf; é\U0001F600!"]


def labelled():
    rows, labels = [], []
    for i in range(120):
        toxic, good = i % 4 == 0, i % 3 != 0
        sentences = [prose(1000 * i + k, 7).capitalize() for k in range(5)]
        if toxic:
            sentences[i % 5] += " you vile oaf"
        text = ". ".join(sentences) + ".\n"
        rows.append((100 + i, text if good else text.upper().replace(" ", " $$ ") * 2, "en", "s", 1))
        labels.append((100 + i, int(good), int(toxic)))
    rows += [(300 + i, text, "en", "s", 1) for i, text in enumerate(ODD)]
    return rows + MESSY, labels


def lowered(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def hashed(word, kind):
    return int(words_of(pa.array([word.decode()]), kind).hashes()[0])


def logistic(x):
    return 1 / (1 + math.exp(-max(-40, min(40, x))))


def compare(got, texts, expected, tolerance=1e-6):
    assert len(got) == len(texts)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r.score)
    wanted = defaultdict(list)
    for r in texts:
        wanted[r[0]].append(expected(r[1]))
    for key in wanted:
        assert np.allclose(sorted(by_id[key]), sorted(wanted[key]), atol=tolerance), key


def test_toxicity_is_the_noisy_or_of_sentences(spark):
    rows, labels = labelled()
    docs = docs_of(spark, rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert np.count_nonzero(model.weights) and 0 < model.leak < 1

    def expected(text):
        clean = 1 - model.leak
        for sentence in re.split(rb"[.!?\n]", lowered(text)):
            words = re.findall(rb"[0-9a-z\x80-\xff]+", sentence)
            if words:
                codes = {hashed(w, ALPHANUMERIC) >> (64 - model.bits) for w in words}
                clean *= 1 - logistic(model.bias + sum(model.weights[c] for c in codes))
        return 1 - clean

    compare(toxicity.score(docs, model).collect(), rows, expected)
    kept = {(r.doc_id, r.text) for r in toxicity.keep_clean(docs, model).collect()}
    assert kept == {(r[0], r[1]) for r in rows if 1 - (1 - expected(r[1])) / (1 - model.leak) < toxicity.OFFENDING}


def plain_statistics(text):
    """What ``quality_fm.STATISTICS`` names, one by one."""
    raw = (text or "").encode()
    words, low = re.findall(rb"[^\x20\x09-\x0D]+", raw), lowered(text)
    n = max(1, len(words))
    lines = [tuple(re.findall(rb"[^\x20\x09-\x0D]+", line)) for line in low.split(b"\n")]
    lines = [line for line in lines if line]
    kinds = [rb"[A-Z]", rb"[0-9]", rb"[#*$%&|<>@_={}\[\]\\^~+]", rb"[.,;:!?]", rb"\n", rb"[\x80-\xff]"]
    return [
        np.log1p(len(words)), sum(map(len, words)) / n, *[len(re.findall(k, raw)) / max(1, len(raw)) for k in kinds],
        len({w.lower() for w in words}) / n, 1 - len(set(lines)) / len(lines) if lines else 0.0,
        sum(w[-1:] in b".,;:!?" for w in words) / n, np.log1p(max(map(len, words), default=0)), len(raw) / n,
    ]


def test_quality_is_the_machine_over_all_pairs(spark):
    rows, labels = labelled()
    docs = docs_of(spark, rows)
    model = quality_fm.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    kinds, bins = len(quality_fm.STATISTICS), quality_fm.BINS
    assert np.allclose(quality_fm.statistics(pa.array([r[1] for r in rows]))[0], [plain_statistics(r[1]) for r in rows])

    def expected(text):
        entries = {k * bins + bisect_right(list(model.edges[k]), s): 1 / math.sqrt(kinds) for k, s in enumerate(plain_statistics(text))}
        codes = {hashed(w, NOT_SPACE) >> (64 - model.bits) for w in re.findall(rb"[^\x20\x09-\x0D]+", lowered(text))}
        entries |= {kinds * bins + c: 1 / math.sqrt(len(codes)) for c in codes}
        used = np.array(list(entries))
        x = np.array(list(entries.values()))
        products = (model.factors[used].astype(float) @ model.factors[used].T.astype(float)) * np.outer(x, x)
        return logistic(model.bias + model.linear[used] @ x + np.triu(products, 1).sum())

    compare(quality_fm.score(docs, model).collect(), rows, expected, 1e-5)


def test_language_model_scores_are_sums_over_tokens_of_averaged_probabilities(spark):
    rows = [(100 + i, " ".join(prose(i % 9 + k % 5, 1) for k in range(i % 40)), "en", "s", 1) for i in range(120)] + MESSY
    rows.append((500, prose(7, 300, "uvwxyz"), "en", "s", 1))
    docs, held = docs_of(spark, rows), remainder("doc_id", 7) == 2
    model, counts = pitman_yor.train(docs.where(~held), Staging(spark), 3)
    samples = range(pitman_yor.BURN_IN, pitman_yor.SWEEPS)
    n, tables, parent = {}, defaultdict(dict), defaultdict(dict)
    for r in counts.collect():
        dishes = pitman_yor._read_counts([bytes(r["counts"])])
        for k, (_, seats, probability) in enumerate(dishes.sweeps(model, r["bucket"], pitman_yor.SWEEPS)):
            for i, (w, c) in enumerate(zip(dishes.word.tolist(), dishes.context.tolist())):
                n[w, c], tables[k][w, c], parent[k][w] = int(dishes.n[i]), int(seats[i]), float(probability[dishes.of[i]])

    def token(text):
        t = pitman_yor.tokens_of(pa.array([text], pa.string()))
        return list(zip(t.word.tolist(), t.context.tolist()))

    trained = defaultdict(int)
    for r in docs.where(~held).collect():
        for dish in token(r.text):
            trained[dish] += 1
    assert trained == n and all(1 <= tables[k][d] <= n[d] for k in samples for d in n)
    theta, d, d0 = pitman_yor.CONCENTRATION, model.discount, model.parent_discount
    customers, of_context = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for (w, c), m in n.items():
        customers[c] += m
        for k in samples:
            of_context[k][c] += tables[k][w, c]

    def expected(text):
        total = 0.0
        for w, c in token(text):
            p = 0.0
            for k in samples:
                totals = model.totals[k + 1]
                fresh = (theta + d0 * totals.parent_tables) / (theta + sum(tables[k].values()))
                base = parent[k][w] if w in parent[k] else fresh * pitman_yor.UNKNOWN_SHARE
                seated = n.get((w, c), 0) - d * tables[k].get((w, c), 0)
                p += (seated + (theta + d * of_context[k][c]) * base) / (theta + customers[c]) / len(samples)
            total += math.log10(p)
        return total

    assert LONG in [r[1] for r in rows]
    compare(pitman_yor.score(docs, held, buckets=3).collect(), rows, expected)
