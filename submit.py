"""Entry point for ``spark-submit``; see ``obslayers.cli``."""

from obslayers.cli import main

if __name__ == "__main__":
    main()
