"""Launcher for spark-submit, from the top of the repository: ``lake_jobs.py <job> ..``."""

from lakestrata.jobs import main

if __name__ == "__main__":
    main()
