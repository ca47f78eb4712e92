"""Entry script for ``spark-submit``; see ``lakehist/cli.py``."""

from lakehist.cli import main

if __name__ == "__main__":
    main()
