import re
from collections import Counter

from rowflow.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
        sum(1 for c in text if c.isupper() and c.lower() != c),
    )


def test_measures_and_bits(documents, odd, prose):
    rows = odd + [(100 + k, t, "s") for k, t in enumerate(prose(40, 30, vocabulary=4) + prose(20, 60))]
    rows += [(200, "a b c d e " * 7, "s"), (201, "A** B#\nc|\n" * 5, "s"), (202, "q " * 12, "s")]
    got = quality.quality_ledger(documents(rows)).collect()
    assert len(got) == len(rows)
    want = Counter((i, *brute(t)) for i, t, _ in rows)
    assert Counter((r.doc_id, *[r[m] for m in quality.MEASURES]) for r in got) == want
    for r in got:
        few, repeated = r.n_words < 10, 100 * r.n_repeat_words > 20 * r.n_words
        assert (r.failures & 1 == 1, r.failures & 2 == 2) == (few, repeated)


def test_policy_keeps_whole_rows(documents, odd, prose):
    clean = [(10 + k, t, "s") for k, t in enumerate(prose(10, 50, seed=3)) if len(t.split()) >= 10]
    docs = documents(odd + clean)
    kept = quality.apply_policy(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i, _, _ in clean}
    assert all(r.n_words == 7 and r["__text"] == "x" for r in kept.collect())
    assert quality.apply_policy(documents([])).count() == 0


def test_ablations_equal_applying_the_policy_without_a_rule(documents, odd, prose):
    rows = odd + [(k, t, "s") for k, t in enumerate(prose(60, 25, vocabulary=5))] + [(300 + k, "a| b| c| d| e| f| g| h| i| j| k|", "s") for k in range(3)]
    ledger = quality.quality_ledger(documents(rows)).cache()
    found = {r.rule: r for r in quality.ablations(ledger, "v2").collect()}
    rejected = ledger.where(~quality.passes("v2")).count()
    for rule in quality.POLICIES["v2"]:
        rest = quality.mask_of(tuple(r for r in quality.POLICIES["v2"] if r != rule))
        without = ledger.where(f"failures & {rest} != 0").count()
        assert found[rule].rejected == rejected
        assert found[rule].only_this == rejected - without
        assert found[rule].fails == ledger.where(quality.any_failed(rule)).count()


def test_plan_has_no_python(documents, prose):
    plan = quality.quality_ledger(documents([(1, "a b", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
