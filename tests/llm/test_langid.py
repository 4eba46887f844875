"""Languages: the encoding against its definition, and held-out accuracy."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest

from tidemark.llm import langid as lang
from tidemark.llm.common import share_of_rows
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string"


def plain_profile(text, dimensions):
    """By the definition, trigram after trigram."""
    letters = [c.lower()[0] if c.isalpha() else " " for c in f" {text} "]
    letters = [c for n, c in enumerate(letters) if c != " " or n == 0 or letters[n - 1] != " "]
    encoder = lang.Encoder(dimensions)
    total = np.zeros(dimensions)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        va, vb, vc = (encoder._letter(ord(x)).astype(int) for x in (a, b, c))
        total += np.roll(va, 2) * np.roll(vb, 1) * vc
    return total / np.linalg.norm(total)


@pytest.mark.parametrize("text", ["Hello, World", "a", "ÄÖ ü\n\n1984 ñandú", "日本語 text", "é" * 300, "İstanbul ǅ 😀 x"])
def test_profile(text):
    assert lang.Encoder(64).profile(text) == pytest.approx(plain_profile(text, 64))


@pytest.mark.parametrize("text", [None, "", "  \n", "1234 !?", "😀 %%%"])
def test_no_letter(text):
    assert lang.Encoder(64).profile(text) is None


def test_forgetting_vectors_changes_nothing(monkeypatch):
    text = "".join(chr(0x4E00 + n * 7 % 3000) for n in range(5000))
    wanted = lang.Encoder(64).profile(text)
    monkeypatch.setattr(lang, "KEPT", 64)
    small = lang.Encoder(64)
    small.profile("some other text that was seen before")
    assert small.profile(text) == pytest.approx(wanted)


def test_memory_of_a_profile():
    """A byte for each dimension of a trigram, and few trigrams turned into numbers at a time."""
    draw = random.Random(3)
    text = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=5000))
    encoder = lang.Encoder(lang.DIMENSIONS)
    encoder.profile("a")
    tracemalloc.start()
    profile = encoder.profile(text)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(encoder.known) > 4000 and profile @ profile == pytest.approx(1)
    assert most < 24 << 20


def test_query_on_held_out_documents(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = QUERIES["op7_language"](spark, SF_DIR).collect()
    assert len(got) == len(truth)
    right = {True: [], False: []}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        right[r.held_out].append(r.lang_pred == truth[r.doc_id].lang)
    assert np.mean(right[True]) > 0.98 and len(right[True]) > 200


def test_labels_of_held_out_documents_are_not_used(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(300)
    spoiled = docs.selectExpr(
        "doc_id", "text", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 'xx', lang) AS lang", "'zz' AS source"
    )
    a, b = (lang.learned_languages(d).vectors for d in (docs, spoiled))
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)


def test_defined_results(spark):
    rows = [(1, "the cat and the dog", "en"), (1, "the cat and the dog", "en"), (3, "der Hund und die Katze", "de"), (4, "zzz", None)]
    rows += [(None, "le chat et le chien", "fr"), (7, None, "en"), (8, "123", "de")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' AS score", "5 AS vector")
    sample = lang.training_sample(docs)
    learned = lang.prototypes(sample)
    assert list(learned) == ["de", "en"]
    got = lang.predicted(docs, learned)
    assert got.columns == ["doc_id", "text", "lang", "vector", "lang_pred", "score"]
    by_text = {r.text: r for r in got.collect()}
    assert by_text["the cat and the dog"].lang_pred == "en" and by_text["der Hund und die Katze"].lang_pred == "de"
    assert (by_text[None].lang_pred, by_text[None].score) == ("und", 0.0) == (by_text["123"].lang_pred, by_text["123"].score)
    kept = lang.recognised(docs, lang.Languages(learned, lang.common_trigrams(sample)))
    assert kept.columns == docs.columns
    assert not {None, "123"} & {r.text for r in kept.collect()}
    nothing = lang.prototypes(lang.training_sample(docs.limit(0)))
    assert nothing == {}
    assert {r.lang_pred for r in lang.predicted(docs, nothing).collect()} == {"und"}


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
    "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았다.",
]


def test_unlearned_languages_and_random_letters_are_rejected(spark):
    rng = random.Random(3)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"]
    alphabets += ["".join(chr(at + n) for n in range(2000)) for at in (0x4E00, 0xAC00)]
    noise = [" ".join("".join(rng.choices(a, k=rng.randint(2, 9))) for _ in range(40)) for a in alphabets for _ in range(40)]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    learned = lang.learned_languages(docs)
    texts = spark.createDataFrame(list(enumerate(FOREIGN + noise)), "doc_id long, text string")
    kept = [r.doc_id for r in lang.recognised(texts, learned).collect()]
    assert not [n for n in kept if n < len(FOREIGN)]
    assert len(kept) <= 0.02 * len(noise)
    ours = docs.filter(lang.held_out(docs.doc_id))
    with_letters = lang.predicted(ours, learned.vectors).filter("lang_pred <> 'und'").count()
    assert lang.recognised(ours, learned).count() >= 0.998 * with_letters > 200


def test_short_clean_texts_are_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    learned = lang.learned_languages(docs)
    ours = docs.filter(lang.held_out(docs.doc_id)).selectExpr("doc_id", "array_join(slice(split(text, ' '), 1, 2), ' ') AS text")
    with_letters = lang.predicted(ours, learned.vectors).filter("lang_pred <> 'und'").count()
    assert lang.recognised(ours, learned).count() >= 0.98 * with_letters > 200
    rng = random.Random(5)
    noise = [" ".join("".join(rng.choices("бвгджzqxkvjwy", k=5)) for _ in range(2)) for _ in range(200)]
    texts = spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string")
    assert lang.recognised(texts, learned).count() <= 10


# Paragraphs out of copyright, unlike the invented prose that is learned.
PROSE = {
    "en": [
        'All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood.',
        'Everyone has the right to life, liberty and security of person.',
        'No one shall be held in slavery or servitude; slavery and the slave trade shall be prohibited in all their forms.',
        'Everyone has the right to recognition everywhere as a person before the law.',
        'No one shall be subjected to arbitrary arrest, detention or exile.',
        'Everyone has the right to freedom of movement and residence within the borders of each State.',
        'It is a truth universally acknowledged, that a single man in possession of a good fortune, must be in want of a wife.',
        'It was the best of times, it was the worst of times, it was the age of wisdom, it was the age of foolishness.',
        'Call me Ishmael. Some years ago, never mind how long precisely, having little or no money in my purse, I thought I would sail about a little and see the watery part of the world.',
        'Everyone has the right to freedom of opinion and expression.',
    ],
    "fr": [
        'Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité.',
        'Tout individu a droit à la vie, à la liberté et à la sûreté de sa personne.',
        "Nul ne sera tenu en esclavage ni en servitude; l'esclavage et la traite des esclaves sont interdits sous toutes leurs formes.",
        'Chacun a le droit à la reconnaissance en tous lieux de sa personnalité juridique.',
        'Nul ne peut être arbitrairement arrêté, détenu ou exilé.',
        "Toute personne a le droit de circuler librement et de choisir sa résidence à l'intérieur d'un État.",
        "Longtemps, je me suis couché de bonne heure. Parfois, à peine ma bougie éteinte, mes yeux se fermaient si vite que je n'avais pas le temps de me dire: je m'endors.",
        "En ce temps-là, la petite ville dormait encore au pied de la montagne, et les cloches de l'église sonnaient doucement dans la brume du matin.",
        "Tout individu a droit à la liberté d'opinion et d'expression.",
        "Les hommes naissent et demeurent libres et égaux en droits. Les distinctions sociales ne peuvent être fondées que sur l'utilité commune.",
    ],
    "de": [
        'Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen.',
        'Jeder hat das Recht auf Leben, Freiheit und Sicherheit der Person.',
        'Niemand darf in Sklaverei oder Leibeigenschaft gehalten werden; Sklaverei und Sklavenhandel in allen ihren Formen sind verboten.',
        'Jeder hat das Recht, überall als rechtsfähig anerkannt zu werden.',
        'Niemand darf willkürlich festgenommen, in Haft gehalten oder des Landes verwiesen werden.',
        'Jeder hat das Recht, sich innerhalb eines Staates frei zu bewegen und seinen Aufenthaltsort frei zu wählen.',
        'Als Gregor Samsa eines Morgens aus unruhigen Träumen erwachte, fand er sich in seinem Bett zu einem ungeheueren Ungeziefer verwandelt.',
        'Jemand mußte Josef K. verleumdet haben, denn ohne daß er etwas Böses getan hätte, wurde er eines Morgens verhaftet.',
        'Jeder hat das Recht auf Meinungsfreiheit und freie Meinungsäußerung.',
        'Habe nun, ach! Philosophie, Juristerei und Medizin, und leider auch Theologie durchaus studiert, mit heißem Bemühn. Da steh ich nun, ich armer Tor, und bin so klug als wie zuvor.',
    ],
    "es": [
        'Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros.',
        'Todo individuo tiene derecho a la vida, a la libertad y a la seguridad de su persona.',
        'Nadie estará sometido a esclavitud ni a servidumbre; la esclavitud y la trata de esclavos están prohibidas en todas sus formas.',
        'Todo ser humano tiene derecho, en todas partes, al reconocimiento de su personalidad jurídica.',
        'Nadie podrá ser arbitrariamente detenido, preso ni desterrado.',
        'Toda persona tiene derecho a circular libremente y a elegir su residencia en el territorio de un Estado.',
        'En un lugar de la Mancha, de cuyo nombre no quiero acordarme, no ha mucho tiempo que vivía un hidalgo de los de lanza en astillero, adarga antigua, rocín flaco y galgo corredor.',
        'Todo individuo tiene derecho a la libertad de opinión y de expresión.',
        'Era una tarde de otoño y el viento traía desde el mar un olor de sal que llenaba las calles vacías del pueblo.',
        'Toda persona tiene derecho a la libertad de reunión y de asociación pacíficas.',
    ],
}


@pytest.mark.parametrize("folder", [SF_DIR, "/root/testdata/sf0.1"])
def test_real_prose_of_learned_languages_is_kept(spark, folder):
    learned = lang.learned_languages(spark.read.parquet(f"{folder}/documents.parquet"))
    texts = [text for each in PROSE.values() for text in each]
    found = lang.recognised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), learned)
    assert found.count() >= 0.95 * len(texts)


def test_query_is_the_plain_cosine_of_every_document(spark):
    """Profiles, bundles and cosines by the definition, over the short documents."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("length(text) < 700 OR text IS NULL")
    learned = lang.prototypes(lang._to_learn_from(docs), 64)
    rows = docs.select("doc_id", "text", "lang").collect()
    bundles = {}
    for text, own in {(r.text, r.lang) for r in rows if r.lang and r.text and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}:
        if any(c.isalpha() for c in text):
            copies = len({r.doc_id for r in rows if (r.text, r.lang) == (text, own) and zlib.crc32(str(r.doc_id).encode()) % 4 != 2})
            bundles[own] = bundles.get(own, 0) + copies * plain_profile(text, 64)
    names = sorted(bundles)
    matrix = np.array([bundles[n] / np.linalg.norm(bundles[n]) for n in names])
    assert list(learned) == names and np.allclose(np.array(list(learned.values())), matrix)
    for r in lang.predicted(docs.select("doc_id", "text"), learned).collect():
        if r.text and any(c.isalpha() for c in r.text):
            cosines = matrix @ plain_profile(r.text, 64)
            assert r.score == pytest.approx(max(0.0, cosines.max()), abs=1e-5)
            assert cosines[names.index(r.lang_pred)] == pytest.approx(cosines.max(), abs=1e-6)
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)


def test_the_sample_keeps_its_bound_without_ids(spark):
    rows = [(None, f"text {n}") for n in range(2000)] + [(7, f"seven {n}") for n in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert 0 < df.filter(share_of_rows(0.01)).count() < 100
