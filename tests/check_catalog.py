"""Run registered queries against their oracles: python tests/check_catalog.py FOLDER [name...]."""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oracle import connect, differences  # noqa: E402

from periodica.catalog import ORACLES, QUERIES  # noqa: E402
from periodica.session import build_session  # noqa: E402


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(8, 8)
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                found = differences(df, con, ORACLES[name])
            else:
                found = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
            if "--trace" in sys.argv:
                traceback.print_exc()
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
