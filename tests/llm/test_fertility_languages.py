import random

from prefmill.llm import fertility
from prefmill.llm.fertility import kept_documents, quality

SENTENCES = {
    "hi": "मेरी दादी का घर नदी के पास है और हम हर दिन रात के खाने से पहले कुत्तों के साथ किनारे पर टहलते हैं",
    "ko": "우리 할머니의 집은 강 근처에 있고 우리는 매일 저녁 식사 전에 강아지들과 함께 강가를 따라 천천히 걷는다",
    "pt": "A casa da minha avó fica perto do rio e todos os dias nós caminhamos pela margem com os cães antes do jantar",
}
ENGLISH = "My grandmother has a house near the river and every day we walk along the bank with the dogs before dinner"


def corpus(spark):
    """Rare languages among many English documents; words are shuffled, so that no window of five is found twice."""
    def long(text, k):
        rng, w = random.Random(k), text.split()
        return " ".join(x for _ in range(4) for x in rng.sample(w, len(w)))

    rows = [(k, ENGLISH, "en") for k in range(6000)]
    rows += [(10_000 * n + k, long(SENTENCES[lang], k), lang) for n, lang in enumerate(SENTENCES, 1) for k in range(n * n // 2 + 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def test_a_rare_language_has_its_own_band(spark):
    df = corpus(spark)
    got = quality(df).where("doc_id >= 10000").collect()
    assert len(got) == 9 and not any(r.base_failed for r in got)
    assert [r.doc_id for r in got if not r.kept] == []


def test_many_bands_are_joined_without_broadcast(spark, monkeypatch):
    df = corpus(spark)
    want = sorted(tuple(r) for r in quality(df).collect())
    monkeypatch.setattr(fertility, "BROADCAST_BANDS", 0)
    assert sorted(tuple(r) for r in quality(df).collect()) == want
    assert sorted(r.doc_id for r in kept_documents(df).collect()) == sorted(r[0] for r in want if r[-1])
