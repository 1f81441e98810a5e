"""spark-submit entry point for the batch job.

    zip -r airlens.zip airlens
    spark-submit --py-files airlens.zip run_job.py --readings <dir> --codes <file> --out <dir>
"""

from airlens.plans.job import main

if __name__ == "__main__":
    main()
