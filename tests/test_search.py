import json

from quernel.sources import readers
from quernel.sources.search import RepositorySearch


def test_pages_are_read_and_searched(spark, tmp_path):
    def repo(name, stars, **more):
        return {"full_name": name, "stargazers_count": stars, "forks_count": 1, "created_at": "2024-05-01T00:00:00Z", "license": {"key": "mit"}, "language": "Python", "archived": False} | more

    (tmp_path / "p1.json").write_text(json.dumps({"items": [repo("a/x", 5), repo("a/y", 50), repo("b/z", 9, archived=True)]}))
    (tmp_path / "p2.json").write_text(json.dumps([repo("c/v", 7, license=None, created_at=None), {}]))
    spark.dataSource.register(RepositorySearch)
    rows = spark.read.format("repository_search").option("url", f"file://{tmp_path}/p{{page}}.json").option("pages", 3).load()
    assert {(r.full_name, r.stars, r.license, r.page) for r in rows.collect()} == {("a/x", 5, "mit", 1), ("a/y", 50, "mit", 1), ("b/z", 9, "mit", 1), ("c/v", 7, None, 2), (None, None, None, 2)}
    asked = {"stars": {"min": 4, "max": 20}, "license": ["MIT"], "language": ["python"], "archived": False, "created_after": "2024-01-01"}
    assert [r.full_name for r in readers.search(rows, asked).collect()] == ["a/x"]
