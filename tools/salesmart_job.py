"""spark-submit entry point for the command line (``python -m salesmart`` equivalent).

    spark-submit --py-files salesmart.zip tools/salesmart_job.py run --config load.json
    spark-submit --py-files salesmart.zip tools/salesmart_job.py validate --warehouse s3a://…
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmart.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
