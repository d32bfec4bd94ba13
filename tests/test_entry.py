"""The catalogue, with and without the folder of text-collection operators."""

import subprocess
import sys


def test_names_and_sql_agree():
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and "p2_found" in q


def test_core_stands_alone():
    code = "import sys; sys.modules['lexweave.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p2_found' in q and 'p9_found' not in q"
    subprocess.run([sys.executable, "-c", code], check=True)
