"""Entry script for ``spark-submit run.py STAGE …``."""

from meterline.__main__ import main

if __name__ == "__main__":
    raise SystemExit(main())
