"""The learned tagger: a fixture of names and ordinary words, and plain versions of both passes."""

import random
import re
from collections import Counter, defaultdict
from itertools import product

import pytest

from crisis_posts.operators import mentions, tagger

GAZETTEER = [
    ("Houston", "LOC"), ("New York", "LOC"), ("Harvey", "EVENT"), ("Rose", "PER"), ("Rose", "ZED"),
    ("Mary  Ann", "PER"), ("York", "PER"), (None, "X"), ("", "X"), ("Nowhere", None),
]
TEXTS = [
    "we saw Houston and New York today. Houston was dry",
    "in Houston, Harvey and Rose met Mary Ann. People left",
    "people said that people in New York Harvey know Rose",
    "they went with Galveston Bay people. Houston people stayed!",
    "the river rose and rose. Rose said so",
    "Harvey hit. Water rose. So people left Houston",
    "and Harvey hit Houston with water", "near Port Aransas and Rockport", None, "", "...", "A b",
]


def posts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def gazetteer(spark, rows=GAZETTEER):
    return spark.createDataFrame(rows, "entity string, type string")


def tokens_of(text):
    return re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|[.!?]+|[^\s]", text or "")


def capital(token):
    return token[0].isalpha() and token[0].isupper()


def begins(tokens, i):
    return i == 0 or tokens[i - 1][0] in ".!?"


def runs(flags):
    out = []
    for i, flag in enumerate(flags):
        if flag and i and flags[i - 1]:
            out[-1].append(i)
        elif flag:
            out.append([i])
    return out


class Plain:
    """Tags, counts and the best of all tag sequences of a run, by trying them all."""

    def __init__(self, texts, rows):
        self.types = [*sorted({t for e, t in rows if e is not None and t is not None} - {"MISC"}), "MISC"]
        known = {}
        for entity, kind in rows:
            if entity and kind:
                name = " ".join(entity.split())
                known[name] = min(known.get(name, 99), self.types.index(kind))
        default = len(self.types) - 1
        self.follows, self.words = Counter(), defaultdict(Counter)
        for text in texts:
            tokens = tokens_of(text)
            inside = [capital(w) and not begins(tokens, i) for i, w in enumerate(tokens)]
            tags = [None if capital(w) else 0 for w in tokens]
            for run in runs(inside):
                whole = known.get(" ".join(tokens[i] for i in run))
                for n, i in enumerate(run):
                    single, before = known.get(tokens[i]), known.get(tokens[i - 1]) if n else 0
                    if whole is not None:
                        tags[i] = 2 * whole + (2 if n else 1)
                    elif single is not None:
                        tags[i] = 2 * single + 1
                    else:
                        tags[i] = 2 * default + (2 if n and before is None else 1)
            self.follows.update((a, b) for a, b in zip(tags, tags[1:]) if None not in (a, b))
            for word, tag in zip(tokens, tags, strict=True):
                if tag is not None and word[0].isalpha():
                    self.words[word.lower()][tag] += 1

    def decode(self, text, model):
        tokens, steps, out = tokens_of(text), model.step_scores(), []
        n = 2 * len(self.types) + 1
        for run in runs([capital(w) for w in tokens]):
            def total(tags, run=run):
                score = 0
                for i, tag in zip(run, tags, strict=True):
                    score += model.word_score(tag, self.words[tokens[i].lower()][tag] if tokens[i].lower() in self.words else 0)
                    score += tagger._thousandths(1, tagger.CAPITAL_WITHIN) if tag == 0 and not begins(tokens, i) else 0
                return score + sum(steps[a][b] for a, b in zip((0, *tags), (*tags, 0), strict=True))
            short = len(run) <= 3
            best = max(total(tags) for tags in product(range(n), repeat=len(run))) if short else 0
            out.append((run, best, total))
        return out


def best_names(best, total, words, types, n):
    """The names of each of the best sequences."""
    every = (t for t in product(range(n), repeat=len(words)) if total(t) == best)
    return [[(x["entity"], x["type"]) for x in tagger.named(words, types, tags)] for tags in every]


def is_made_of(found, choices):
    """Whether a list is one choice after another."""
    if not choices:
        return not found
    return any(found[: len(c)] == c and is_made_of(found[len(c) :], choices[1:]) for c in choices[0])


@pytest.mark.parametrize("max_rows", [50_000, 0])
def test_counts_and_best_sequences(spark, max_rows):
    rng = random.Random(9)
    vocabulary = ["Houston", "New", "York", "Harvey", "Rose", "rose", "people", "People", "in", ".", ",", "Bay"]
    texts = TEXTS + [" ".join(rng.choices(vocabulary, k=rng.randint(1, 14))) for _ in range(60)]
    model = tagger.learn_tagger(posts(spark, texts), gazetteer(spark), max_rows=max_rows)
    plain = Plain(texts, GAZETTEER)
    assert list(model.types) == plain.types
    n = len(model.totals)
    assert [[plain.follows[a, b] for b in range(n)] for a in range(n)] == [list(x) for x in model.follows]
    assert model.vocabulary == len(plain.words)
    assert list(model.totals) == [sum(c[t] for c in plain.words.values()) for t in range(n)]
    assert list(model.kinds) == [sum(c[t] > 0 for c in plain.words.values()) for t in range(n)]
    for row in model.words.collect():
        assert row.value == [plain.words[row.word][t] if row.word in plain.words else 0 for t in range(n)]
    found, checked = tagger.tag_names(posts(spark, texts), model, max_rows=max_rows).collect(), 0
    assert len(found) == sum(t is not None for t in texts)
    for row in found:
        decoded = plain.decode(row.text, model) if len(row.text) < 90 else []
        if decoded and max(len(run) for run, *_ in decoded) <= 3:
            tokens = tokens_of(row.text)
            choices = [
                best_names(best, total, [tokens[i] for i in run], plain.types, n) for run, best, total in decoded
            ]
            assert is_made_of([tuple(e) for e in row.entities], choices), row
            checked += 1
    assert checked > 30


def test_a_name_and_an_ordinary_word_at_the_start_of_a_sentence(spark):
    model = tagger.learn_tagger(posts(spark, TEXTS * 5), gazetteer(spark))
    texts = ["Houston floods", "People flee", "Water rises in Rockport", "so Rose met Mary Ann in New York"]
    found = {r.text: [tuple(e) for e in r.entities] for r in tagger.tag_names(posts(spark, texts), model).collect()}
    assert found["Houston floods"] == [("Houston", "LOC")]
    assert found["People flee"] == []
    assert found["Water rises in Rockport"] == [("Rockport", "MISC")]
    assert ("Mary Ann", "PER") in found["so Rose met Mary Ann in New York"]
    assert ("New York", "LOC") in found["so Rose met Mary Ann in New York"]


def test_viterbi_against_all_sequences():
    rng = random.Random(6)
    for _ in range(300):
        n, length = rng.choice([1, 3, 5]), rng.randint(1, 5)
        steps = [[rng.randint(-9, 0) for _ in range(n)] for _ in range(n)]
        words = [[rng.randint(-9, 0) for _ in range(n)] for _ in range(length)]

        def total(tags):
            return sum(w[t] for w, t in zip(words, tags, strict=True)) + sum(
                steps[a][b] for a, b in zip((0, *tags), (*tags, 0), strict=True)
            )

        found = tagger.viterbi(words, steps)
        assert total(found) == max(total(tags) for tags in product(range(n), repeat=length))


def test_found_names_go_on_like_other_mentions(spark):
    model = tagger.learn_tagger(posts(spark, TEXTS), gazetteer(spark))
    tagged = tagger.tag_names(posts(spark, TEXTS), model)
    counts = mentions.mention_counts(mentions.canonical_mentions(mentions.explode_mentions(tagged)))
    assert {(r.Entity, r.Type) for r in counts.collect()} >= {("Houston", "LOC"), ("Harvey", "MISC")}


def test_empty_tables_and_too_many_types(spark):
    nothing = tagger.learn_tagger(posts(spark, []), gazetteer(spark).limit(0))
    assert nothing.types == ("MISC",) and nothing.vocabulary == 1
    assert tagger.tag_names(posts(spark, ["Some Name x", ""]), nothing).count() == 2
    many = gazetteer(spark, [(f"E{i}", f"t{i}") for i in range(tagger.MAX_TYPES + 1)])
    with pytest.raises(ValueError, match="types"):
        tagger.learn_tagger(posts(spark, TEXTS), many)


def test_a_long_run_is_decoded_in_linear_time(spark):
    model = tagger.learn_tagger(posts(spark, TEXTS), gazetteer(spark))
    (row,) = tagger.tag_names(posts(spark, ["x " + "HOUSTON Bay " * 20_000]), model).collect()
    assert sum(len(e.entity.split(" ")) for e in row.entities) <= 40_000


def test_every_word_with_a_capital_is_asked_for(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices("aB'’-. é́É", k=rng.randint(0, 30))) for _ in range(2000)]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    asked = table.select(tagger._tokens("text").alias("all"), tagger._capital_words("text").alias("asked"))
    for row in asked.collect():
        assert {w for w in row.all if w[0] in "BÉ"} <= set(row.asked)


def test_a_joined_look_up_moves_no_tokens(spark):
    texts = ["So Rome and Paris met."]
    model = tagger.learn_tagger(posts(spark, texts), gazetteer(spark))
    plan = tagger.tag_names(posts(spark, texts), model, max_rows=0)._jdf.queryExecution()
    joins = [line for line in plan.executedPlan().toString().split("\n") if "Exchange hashpartitioning" in line]
    below = plan.optimizedPlan().toString().split("Join LeftOuter")[1]
    assert joins and "_tokens" not in below.split("Aggregate")[0]
