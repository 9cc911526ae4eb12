"""Predictions against a plain version: words one by one, all languages, all switches."""

import math
from collections import Counter

import numpy as np

from stepweave.llm import language_id as L


def plain_words(text):
    """Runs of letters, lower case."""
    words, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append(word)
            word = ""
    return words


def plain_bucket(before, letter, after):
    mask = 0xFFFFFFFF
    value = before * 0x9E3779B1 & mask
    value ^= letter * 0x85EBCA77 & mask
    value = (value ^ value >> 15) + (after * 0xC2B2AE3D & mask) & mask
    value = value * 0x27D4EB2F & mask
    return value >> 32 - (L.BUCKETS.bit_length() - 1)


def plain_buckets(word):
    codes = [0, *map(ord, word), 0]
    return [plain_bucket(*codes[i - 1 : i + 2]) for i in range(1, len(codes) - 1)]


def plain_script(word):
    return next(s for start, s in reversed(L.SCRIPT_RANGES) if ord(word[0]) >= start)


class PlainModel:
    def __init__(self, rows):
        counts, letters = {}, {}
        for text, lang in rows:
            if text is None or lang is None:
                continue
            counts.setdefault(lang, Counter())
            letters.setdefault(lang, Counter())
            for word in plain_words(text):
                counts[lang].update(plain_buckets(word))
                letters[lang][plain_script(word)] += len(word)
        self.languages = sorted(counts)
        self.counts, self.letters = counts, letters

    def score(self, word, lang):
        own = self.counts[lang]
        whole = own.total() + 0.5 * L.BUCKETS
        score = sum(math.log((own[b] + 0.5) / whole) for b in plain_buckets(word))
        script = plain_script(word)

        def uses(other):
            found = self.letters[other]
            return found[script] >= L.SCRIPT_SHARE * max(found.total(), 1)

        if not uses(lang) and any(map(uses, self.languages)):
            score -= L.WRONG_SCRIPT
        return score

    def predict(self, text):
        words = plain_words(text)
        if not words or not self.languages:
            return "und", 0.0
        best = {lang: (self.score(words[0], lang), [lang]) for lang in self.languages}
        for word in words[1:]:
            new = {}
            for lang in self.languages:
                value, path = max(
                    ((v - (0 if other == lang else L.SWITCH), p) for other, (v, p) in best.items()),
                    key=lambda x: x[0],
                )
                new[lang] = (value + self.score(word, lang), [*path, lang])
            best = new
        path = max(best.values(), key=lambda x: x[0])[1]
        letters = Counter()
        for word, lang in zip(words, path, strict=True):
            letters[lang] += len(word)
        winner = min(letters, key=lambda lang: (-letters[lang], lang))
        return winner, letters[winner] / letters.total()


def test_predictions_like_the_plain_version(spark):
    random = np.random.default_rng(3)
    parts = {
        "en": "the house and tree are in this big green field with".split(),
        "de": "das haus und der baum sind in diesem großen grünen feld".split(),
        "ru": "дом и дерево стоят в этом большом зелёном поле".split(),
        "el": "το σπίτι και το δέντρο είναι σε αυτό".split(),
    }

    def text(lang, n):
        return " ".join(random.choice(parts[lang], n))

    learn = [(text(lang, 30), lang) for lang in parts for _ in range(6)]
    learn += [(None, "en"), ("", "de"), ("words without a label", None), ("123 !", "xx")]
    asked = [None, "", "12 %", "a", "é", "İstanbul DAS Haus", "dom", "漢字 the house"]
    for _ in range(40):
        a, b = random.choice(list(parts), 2)
        asked.append(f"{text(a, random.integers(1, 12))}, {text(b, random.integers(1, 12)).upper()}\n")
    model = L.train(spark.createDataFrame(learn, "text string, lang string"))
    plain = PlainModel(learn)
    assert model.languages == plain.languages
    rows = list(enumerate(asked))
    docs = spark.createDataFrame(rows, "number int, text string").repartition(3)
    found = {r.number: r for r in L.label_languages(docs, model).collect()}
    for number, text_ in rows:
        lang, score = plain.predict(text_)
        assert found[number].lang_pred == lang, (text_, lang)
        assert math.isclose(found[number].lang_score, score, abs_tol=1e-9), text_
        assert sum(s.words for s in found[number].lang_spans) == len(plain_words(text_))
