import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """n words of invented prose."""
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("abdeghilmnorstuvé") for _ in range(rnd.randint(1, 9))) for _ in range(3000)]
    return lambda n, seed=None: " ".join((random.Random(seed) if seed is not None else rnd).choices(vocabulary, k=n))


DOCS = "doc_id long, text string, source string, lang string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda rows: spark.createDataFrame([(*r, "s", "en", 0)[:5] if len(r) < 5 else r for r in rows], DOCS)


class Store:
    """Folders by a scheme that Spark's file systems alone know: viewfs, mounted on a local folder."""

    def __init__(self, spark, folder):
        self.folder, self.conf = folder, spark._jsc.hadoopConfiguration()
        for name, at in (("in", "/"), ("out", str(folder))):
            self.conf.set(f"fs.viewfs.mounttable.tests.link./{name}", f"file://{at}")

    def __call__(self, path):
        return f"viewfs://tests/in{path}"

    def new(self, name):
        return f"viewfs://tests/out/{name}"


@pytest.fixture(scope="session")
def store(spark, tmp_path_factory):
    return Store(spark, tmp_path_factory.mktemp("store"))
