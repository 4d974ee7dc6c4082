"""spark-submit entry point: ``spark-submit --py-files lakestrata.zip lakestrata_job.py <job> ...``
(see ``lakestrata/cli.py`` for the jobs and their arguments)."""

from lakestrata.cli import main

if __name__ == "__main__":
    main()
