from starmart import RawZone
from starmart.sources.raw import JdbcSplit


class Reader:
    """Records what is asked of ``spark.read``."""

    def __init__(self):
        self.calls = []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return f"frame of {table}"


def test_live_tables_are_read_in_ranges():
    session = Reader()
    zone = RawZone.jdbc(
        session, "jdbc:x", {"Orders": JdbcSplit("OrderID", 1, 1000, 16)}, {"user": "u"}
    )
    assert zone.table("Orders") == "frame of Orders"
    assert zone.table("Genre") == "frame of Genre"
    assert session.calls == [
        (
            "jdbc:x",
            "Orders",
            {
                "column": "OrderID",
                "lowerBound": 1,
                "upperBound": 1000,
                "numPartitions": 16,
                "properties": {"user": "u"},
            },
        ),
        ("jdbc:x", "Genre", {"properties": {"user": "u"}}),
    ]


def test_a_table_is_opened_once():
    session = Reader()
    zone = RawZone.jdbc(session, "jdbc:x", {})
    zone.table("T")
    zone.table("T")
    assert len(session.calls) == 1
    other = zone.replacing(T="another")
    assert other.table("T") == "another" and zone.table("T") == "frame of T"
