import pytest
from texts import LONG, prose


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty, blank, very long and repeated texts, ties, and ids that are null, repeated or negative."""
    same = prose(1, 120)
    return [
        (1, None), (2, ""), (3, " \n\t\r\x0b\x0c "), (4, "one"), (5, LONG), (6, same), (7, same), (6, same),
        (8, prose(2, 90)), (8, prose(3, 90)), (None, same), (None, None), (-9, same + " tail"), (10, "▁ \x00 ퟿ 𝄞 é"),
        (11, prose(2, 90)), (12, "a a a a a " * 40), (13, prose(4, 19)), (14, prose(4, 20)), (15, prose(4, 20)),
    ]


#: Columns that operators use inside, as strangers.
CLASHES = "id part bucket component words own hits spots n_words start shard slot tree host kept odd bands piece_ids chunk".split()


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    rows = [(k, t, *(["x"] * len(CLASHES))) for k, t in edge_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHES))


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
