"""Entry point for spark-submit; see ``python -m stoplens --help``."""

from stoplens.__main__ import main

if __name__ == "__main__":
    main()
