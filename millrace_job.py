"""spark-submit entry for the ingest job (see ``python -m millrace --help``).

    spark-submit --py-files millrace.zip millrace_job.py ingest --landing ... --target ... --control ...
"""

import sys

from millrace.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
