"""Tables with every awkward row, and empty ones, as folders that queries read."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

PROSE = (
    "The house on the hill was built by the family of a man who had come from the sea and it is said that "
    "for many years the light in the window was seen by all of the ships that came near to the land at night "
    "and that it was put out only when the last of them was home with its crew and its goods to be sold in town"
)
# Columns of other meaning under names that operators use.
CLASHING = (
    "score lang_pred n_words failed length piece ids sequence_id offset predicted fingerprint component_id _row "
    "n_removed line keeper decoded hash bytes shard depth page rank u v root "
    "prefix_tokens n_tokens n_bytes term n docs items kept total z p q"
).split()

TEXTS = [
    PROSE,
    PROSE,
    None,
    "",
    " \n\t ",
    "12 34 !?",
    "x",
    PROSE + " and more of it",
    " ".join(f"{PROSE} {i}" for i in range(300)),
    "a" * 200_000,
    "Der Hund und die Katze sind mit dem Kind von der Frau in das Haus gegangen\nAll rights reserved by us.",
    "naïve İstanbul é 日本語 \U0001f600 <|endoftext|> x\x1cy　z",
]


def documents() -> pa.Table:
    ids = [*range(len(TEXTS)), 0, None]
    texts = [*TEXTS, TEXTS[0], "no id at all"]
    table = {
        "doc_id": pa.array(ids, pa.int64()),
        "text": pa.array(texts, pa.string()),
        "lang": pa.array([("en", "de", None)[i % 3] for i in range(len(ids))], pa.string()),
        "source": pa.array([None if i % 4 == 3 else f"s{i % 4}" for i in range(len(ids))], pa.string()),
        "n_chars": pa.array([None if t is None else len(t) for t in texts], pa.int64()),
    }
    return pa.table(table | {c: pa.array(["clash"] * len(ids)) for c in CLASHING})


def labels() -> pa.Table:
    rows = [(0, 1, 0), (1, 1, 1), (1, 1, 0), (7, None, None), (None, 0, 1), (8, 0, 0)]
    ids, quality, toxic = zip(*rows)
    return pa.table(
        {"doc_id": pa.array(ids, pa.int64()), "quality": pa.array(quality, pa.int32()), "toxic": pa.array(toxic, pa.int32())}
    )


def embeddings() -> pa.Table:
    vectors = [[0.5, 0.25], None, [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [0.5, 0.25], [-1.0, 2.0], [0.1], []]
    ids = [*range(0, 20 * len(vectors), 20)]
    return pa.table(
        {
            "vec_id": pa.array([*ids, None, 7], pa.int64()),
            "embedding": pa.array([*vectors, [1.0, 1.0], [0.5, 0.25]], pa.list_(pa.float32())),
            "label": pa.array([0] * (len(ids) + 2), pa.int32()),
            "id": pa.array(["clash"] * (len(ids) + 2)),
            "vector": pa.array(["clash"] * (len(ids) + 2)),
        }
    )


def pages() -> pa.Table:
    html = [None, "", "<", f"<body><nav>menu</nav><p>{PROSE}</p></body>", "<p>" * 3000 + "deep", "text &amp; more", "<script>x"]
    return pa.table(
        {
            "page_id": pa.array([*range(len(html) - 1), None], pa.int64()),
            "url": pa.array([None] * len(html), pa.string()),
            "html": pa.array(html, pa.string()),
            "text": pa.array([1] * len(html)),
            "n_chars": pa.array(["clash"] * len(html)),
        }
    )


def conversations() -> pa.Table:
    """NULL and repeated turns, NULL ids, a conversation that borrows all it has, copies, a prefix of another."""
    rows = [
        *((0, t, "user", f"hello there {t}") for t in range(5)),
        *((c, t, "user", f"hello there {t}") for c in (1, 2, 3, 4, 20) for t in range(5)),
        (5, None, None, None),
        (5, 1, "user", "one two"),
        (5, 1, "user", "one two"),
        (6, 0, None, "x" * 100_000),
        (7, 0, "user", ""),
        (25, 3, "bot", "alone"),
        (41, 0, "bot", "first of its twenty is missing"),
        (44, 0, "bot", "a"),
        (44, 1, "bot", "b"),
        (-5, 0, "user", "a negative id"),
        (None, 0, "user", "of no conversation"),
    ]
    rows += [(c, 0, "user", "short") for c in range(60, 90)]
    conv, turn, role, text = zip(*rows)
    columns = {"conv_id": pa.array(conv, pa.int64()), "turn": pa.array(turn, pa.int64()), "role": pa.array(role), "text": pa.array(text)}
    return pa.table(columns | {c: pa.array(["clash"] * len(rows)) for c in ("n", "part", "key", "depth", "sequence", "words", "hi")})


def write(folder, empty: bool) -> str:
    for make in (documents, labels, embeddings, pages, conversations):
        table = make()
        pq.write_table(table.slice(0, 0) if empty else table, folder / f"{make.__name__}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def awkward(tmp_path_factory):
    return write(tmp_path_factory.mktemp("awkward"), empty=False)


@pytest.fixture(scope="session")
def nothing(tmp_path_factory):
    return write(tmp_path_factory.mktemp("nothing"), empty=True)
