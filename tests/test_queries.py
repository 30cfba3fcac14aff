from fieldtally import queries
from fieldtally.sources import readers
from tests.conftest import DATA


def test_categories_have_no_row_limit(spark, monkeypatch):
    limits = []
    own = readers.run_sql
    monkeypatch.setattr(readers, "run_sql", lambda *a, limit=1000: limits.append(limit) or own(*a, limit=limit))
    queries.queries()["kategori_count"](spark, DATA)
    assert limits == [None]
    assert readers.run_sql(spark, "SELECT * FROM range(1500)", limit=None).count() == 1500
    assert readers.run_sql(spark, "SELECT * FROM range(1500)").count() == 1000
