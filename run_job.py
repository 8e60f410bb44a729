"""Entry point for spark-submit, see duelmetrics/jobs.py."""

from duelmetrics.jobs import main

if __name__ == "__main__":
    main()
