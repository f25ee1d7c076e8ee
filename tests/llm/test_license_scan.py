import itertools
import random

from lodgespark.llm import license_scan as ls, queries
from tests.llm.helpers import EDGE_TEXTS, documents

SF = "/root/testdata/sf0.01"


def best_dice(text, template):
    """Best Dice coefficient of any passage, by trying them all."""
    words, other = ls.normalised_words(text), ls.normalised_words(template)
    b = set(zip(other, other[1:]))
    best = 0.0
    for i, j in itertools.combinations(range(len(words) + 1), 2):
        a = set(zip(words[i:j], words[i + 1:j]))
        if a:
            best = max(best, 2 * len(a & b) / (len(a) + len(b)))
    return best


def test_findings_against_all_passages():
    rng = random.Random(1)
    template = "alpha beta gamma delta epsilon zeta eta theta"
    scanner = ls.Scanner({"T": [template]}, 0.7)
    words = template.split() + ["other", "words"]
    for _ in range(300):
        base = template.split()
        for _ in range(rng.randint(0, 4)):
            base[rng.randrange(len(base))] = rng.choice(words)
        text = " ".join(rng.choices(words, k=rng.randint(0, 6)) + base + rng.choices(words, k=rng.randint(0, 6)))
        want, got = best_dice(text, template), scanner.scan(text)
        assert bool(got) == (want >= 0.7), text
        if got:
            assert abs(max(g[1] for g in got) - want) < 1e-5


def test_passages_that_repeat_their_bigrams_have_any_length():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(24)]
    scanner = ls.Scanner({"T": [" ".join(words)]}, 0.7)
    found = 0
    for _ in range(60):
        at = rng.randint(2, 22)
        filler = ["x", "y"] * rng.randint(0, 60) if rng.random() < 0.7 else words[at - 2:at] * rng.randint(0, 60)
        text = " ".join(["z"] * rng.randint(0, 3) + words[:at] + filler + words[at:rng.randint(at, 24)])
        want, got = best_dice(text, " ".join(words)), scanner.scan(text)
        assert bool(got) == (want >= 0.7), text
        if got:
            found += 1
            assert abs(max(g[1] for g in got) - want) < 1e-5
    assert found > 20
    long = scanner.scan(" ".join(words[:12] + ["x", "y"] * 50_000 + words[12:]))
    assert [(g[2], g[3]) for g in long] == [(0, 100_024)]


def test_every_template_finds_itself_in_prose():
    scanner = ls.Scanner(ls.TEMPLATES)
    for name, texts in ls.TEMPLATES.items():
        for t in texts:
            got = scanner.scan("Some prose goes first. " + t.upper().replace(",", " ,\n") + " And some more prose comes last here.")
            assert name in {g[0] for g in got if g[1] > 0.95}, name
    assert scanner.scan("the software is nice and the license of the work is for you") == []


def test_passages_do_not_overlap_and_long_texts():
    scanner = ls.Scanner(ls.TEMPLATES)
    text = "\n".join(["Released under the MIT License.", "Licensed under the Apache License, Version 2.0."] * 500)
    got = scanner.scan(text)
    assert len(got) == 1000 and all(a[3] <= b[2] for a, b in zip(got, got[1:]))


def test_frames(spark):
    texts = EDGE_TEXTS + ["x\nReleased under the MIT License.", "x\nReleased under the MIT License.", "LICENSED UNDER CC BY-NC 4.0 !"]
    got = {r.doc_id: r for r in ls.scan_documents(documents(spark, texts)).collect()}
    n = len(EDGE_TEXTS)
    assert all(got[i].n_licenses == 0 and got[i].license is None for i in range(n))
    assert (got[n].license, got[n].dice, got[n].n_licenses) == ("MIT", 1.0, 1) and got[n][1:] == got[n + 1][1:]
    assert got[n + 2].license == "CC-BY-NC-4.0"
    assert ls.scan_documents(documents(spark, [])).count() == 0


def test_query_finds_the_planted_lines(spark):
    got = {r.doc_id: r.license for r in queries.QUERIES["op4_license_scan"](spark, SF).collect()}
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "Released under the MIT License.": "MIT", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        planted = {v for k, v in lines.items() if k in r.text}
        assert got[r.doc_id] in planted if planted else got[r.doc_id] is None
