"""Entry for spark-submit; see ``telewarden/job.py`` for the arguments."""

from telewarden.job import main

if __name__ == "__main__":
    main()
