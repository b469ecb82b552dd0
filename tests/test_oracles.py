import pytest

from spindrift import catalogue

from .oracle import connection, same


@pytest.fixture(scope="module")
def tables():
    pytest.importorskip("duckdb")
    return connection()


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(spark, tables, name):
    same(spark, tables, catalogue.queries()[name], catalogue.oracle_sql()[name])


def test_descriptions_of_any_first_letter_equal_their_sql(spark, tmp_path):
    pytest.importorskip("duckdb")
    cased = [x for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and ((x := chr(c)).upper() != x or x.lower() != x)]
    later = [*"\u1c8a\ua7cd\ua7db", *map(chr, range(0x10D70, 0x10D86))]
    texts = [x + rest for x in cased + later for rest in ("", "\u0308 ß.")] + ["  ß \nx", " ", "", ".", "a ", "ßß", "\u0301e", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    name = "description_normalize"
    same(spark, connection(tmp_path), catalogue.queries()[name], catalogue.oracle_sql()[name], tmp_path)
