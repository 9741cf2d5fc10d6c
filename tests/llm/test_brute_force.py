"""Whole queries against plain Python that shares no code with them."""

import math
import os
import pathlib
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

from gridloom.llm import decontaminate as dc
from gridloom.llm import language_cnn as cnn
from gridloom.llm import quality_gam as qg
from gridloom.llm import surrogates as pii

# --- op7: templates, shifts, runs and slots ---------------------------------

N, U, P = "", "", ""
SPACE = "[ \t\n\x0b\f\r]"


def blank_split(text):
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]


def template(text):
    text = regex.sub(r"[0-9]+(?:[.,:/][0-9]+)*", N, text)
    text = regex.sub(rf"(?<={N}{SPACE}?)(?:{dc.UNITS})(?![\p{{L}}\p{{N}}])", U, text)
    text = regex.sub(rf"(?<=[\p{{L}}\p{{N}},;]{SPACE})\p{{Lu}}\p{{Ll}}+", P, text)
    return blank_split(regex.sub(rf"[^\p{{L}}\p{{M}}\p{{N}}{N}-{P}\x09-\x0D\x20]+", "", text.lower()))


def plain(text):
    text = regex.sub(rf"(?<=[0-9]{SPACE}?)[%$€£]", "q", text)
    return blank_split(regex.sub(rf"[^\p{{L}}\p{{M}}\p{{N}}{N}-{P}\x09-\x0D\x20]+", "", text.lower()))


def covered(at, w):
    return len({i + k for i in at for k in range(w)})


def leaks(doc_t, doc_v, item_t, item_v):
    """Whether a document holds an item: every shift is looked at on its own."""
    short = len(item_t) < 5
    key, words = (item_v, doc_v) if short else (item_t, doc_t)
    size, w = len(key), min(len(key), 8)
    places = defaultdict(list)
    for i in range(size - w + 1):
        places[tuple(key[i : i + w])].append(i)
    at = defaultdict(set)
    for j in range(len(words) - w + 1):
        for i in places.get(tuple(words[j : j + w]), ()):
            at[j - i].add(i)
    if not at:
        return False
    cover = covered(set().union(*at.values()), w) / size
    best = max(at, key=lambda s: (len(at[s]), -s))
    for s, hit in at.items():
        spans = []
        if covered(hit, w) / size >= 0.5 or (cover >= 0.5 and s == best):
            spans.append((0, size - 1, False))
        for first in (i for i in hit if i - 1 not in hit):
            last = first
            while last + 1 in hit:
                last += 1
            if last + w - first >= 13:
                spans.append((first, last + w - 1, True))
        for first, last, run in spans:
            met = Counter()
            for p in range(first, last + 1):
                if regex.search(f"[{N}-{P}]", item_t[p]) and 0 <= p + s < len(doc_t) and doc_t[p + s] == item_t[p]:
                    met[item_v[p], doc_v[p + s]] += 1
            of_item = {a: max((n, b) for (x, b), n in met.items() if x == a)[1] for a, _ in met}
            of_doc = {b: max((n, a) for (a, x), n in met.items() if x == b)[1] for _, b in met}
            total = sum(met.values())
            follows = sum(n for (a, b), n in met.items() if of_item[a] == b and of_doc[b] == a)
            same = sum(n for (a, b), n in met.items() if a == b)
            if (follows >= 0.8 * total - 1e-12) and (not run or last - first + 1 - total + same >= 8):
                return True
    return False


def test_decontamination(spark, sf_dir):
    got = {(r["doc_id"], r["item_id"]) for r in dc.op7_benchmark_decontamination(spark, sf_dir).collect()}
    items = {}
    for r in sorted(spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()):
        words = tuple(template(r["text"] or "")), tuple(plain(r["text"] or ""))
        if words[0]:
            items.setdefault(words, r["item_id"])
    want = set()
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        t, v = template(d["text"] or ""), plain(d["text"] or "")
        want |= {(d["doc_id"], i) for (it, iv), i in items.items() if leaks(t, v, it, iv)}
    assert got == want and len(want) > 0


# --- op2: statistics and sums of tables --------------------------------------


def statistics(text):
    raw = (text or "").encode()
    ws = re.findall(rb"[^ \t\n\x0b\f\r]+", raw)
    if not ws:
        return [0.0] * 16
    n, count = len(ws), lambda chars: sum(raw.count(bytes([c])) for c in chars.encode())
    lines = [x for x in raw.split(b"\n") if re.search(rb"[^ \t\n\x0b\f\r]", x)]
    return [
        math.log(1 + n), sum(map(len, ws)) / n, min(max(map(len, ws)), 1000), sum(len(w) <= 3 for w in ws) / n, count("#*$%&<>") / n, count("|") / n,
        count("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / len(raw), count("0123456789") / len(raw), count("!?") / n, n / (1 + count(".!?")), count(",;:") / n,
        sum(b >= 128 for b in raw) / len(raw), len(set(ws)) / n, sum(a == b for a, b in zip(ws, ws[1:])) / n, max(Counter(ws).values()) / n, 1 - len(set(lines)) / len(lines),
    ]


def test_quality_scores(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    model = qg.fit_model(qg.features(docs), labels)
    bin_of = lambda edges, x: sum(x >= e for e in edges)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = qg.op2_quality_classifier(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        x = statistics(texts[r["doc_id"]])
        margin = model.base + sum(table[bin_of(edges, v)] for edges, table, v in zip(model.edges, model.tables, x))
        margin += sum(cells[bin_of(model.coarse[a], x[a]), bin_of(model.coarse[b], x[b])] for (a, b), cells in model.pairs.items())
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9) and r["predicted"] == (r["score"] >= 0.3)


# --- op4: the same mention has the same surrogate ------------------------------

MENTIONS = {
    "email": r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+",
    "ip": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w.])",
    "phone": r"\+1 \(\d{3}\) \d{3}-\d{4}",
}


def test_surrogates(spark, sf_dir):
    """Found by simple patterns in the text and in the result: as many, one to one over the corpus, none of them left."""
    before = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    after = {r["doc_id"]: r["text"] for r in pii.op4_pii_surrogates(spark, sf_dir).collect()}
    assert before.keys() == after.keys()
    for kind, pattern in MENTIONS.items():
        seen, total = {}, 0
        for i, text in before.items():
            old, new = re.findall(pattern, text), re.findall(pattern, after[i])
            assert len(old) == len(new), (kind, i)
            total += len(old)
            for a, b in zip(old, new):
                assert seen.setdefault(a.lower(), b.lower()) == b.lower() and [len(x) for x in a.split("@")] == [len(x) for x in b.split("@")] or kind == "ip"
        assert len(set(seen.values())) == len(seen) and not set(seen) & set(seen.values())
        assert total > 0 or kind == "phone"


# --- op5: the mean over all windows ---------------------------------------------


def test_language_scores(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    network = cnn.fit_network(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    tables = network.tables()
    for r in cnn.op5_language_id(spark, sf_dir).collect():
        text = texts[r["doc_id"]]
        if text is None or not re.search(r"[^\W\d_]", text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        each = np.concatenate([network.probabilities(row[None, :], tables) for row in cnn.windows(text)])
        mean = each.astype(float).mean(axis=0)
        assert r["lang_pred"] == network.languages[int(mean.argmax())] and r["score"] == pytest.approx(mean.max(), abs=1e-4)


def test_tasks_do_not_need_the_package(tmp_path, sf_dir):
    """Workers started outside the repository, as on a cluster, cannot import the package."""
    script = tmp_path / "job.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {str(pathlib.Path(__file__).resolve().parent.parent.parent)!r})\n"
        "from gridloom.llm.catalog import QUERIES\n"
        "from gridloom.session import build_session\n"
        "spark = build_session('job', 'local[4]', spark__sql__shuffle__partitions='4')\n"
        "for name, query in QUERIES.items():\n"
        f"    query(spark, {sf_dir!r}).write.format('noop').mode('overwrite').save()\n"
        "    print(name, True)\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.stdout.count("True") == 14, done.stderr[-2000:]
