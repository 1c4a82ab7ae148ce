"""Entry script of the build job, for spark-submit."""

from vitrine.plans.pipeline import main

if __name__ == "__main__":
    raise SystemExit(main())
