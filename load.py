"""Entry script of the full run: ``spark-submit load.py --help``."""

from sparkmart.plans.main import main

if __name__ == "__main__":
    main()
