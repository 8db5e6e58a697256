"""Which rows teach the languages."""

from tidemark.llm import language

SETTINGS = language.Settings(train_rows=60)


def docs(spark):
    rows = [(f"the cat number {'x' * (i % 7)}{chr(97 + i % 26)} of row {i}", "en") for i in range(3000)]
    rows += [("the hot copy of one text", "en")] * 3000
    rows += [("hund und katze und haus und hund", "de"), ("le chat et le chien et le chat", "fr")]
    return spark.createDataFrame([*rows, (None, "it"), ("no language", None)], "text string, lang string")


def test_every_language_is_learned(spark):
    found = docs(spark)
    model = language.fit(found, SETTINGS)
    assert model.languages == ["de", "en", "fr"]
    rare = found.filter("lang in ('de', 'fr')")
    assert all(r["lang"] == r["lang_pred"] for r in language.predict(rare, model).collect())


def test_languages_of_one_text_without_repeats_are_learned(spark):
    rows = [("the cat and the dog", "en")] * 20 + [("\u79c1\u306f\u732b", "ja"), ("zq xw", "qq")]
    found = spark.createDataFrame(rows, "text string, lang string")
    model = language.fit(found)
    assert model.languages == ["en", "ja", "qq"]
    assert all(r["lang"] == r["lang_pred"] for r in language.predict(found, model).collect())


def test_the_bound_holds_and_copies_count_once(spark):
    rows = docs(spark).filter("lang is not null and text is not null")
    taken = [tuple(r) for r in language.training_rows(rows, SETTINGS).collect()]
    assert len(taken) == len(set(taken))
    assert {lang: sum(r[0] == lang for r in taken) for lang in ("de", "en", "fr")} == {"de": 1, "en": 20, "fr": 1}
