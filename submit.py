"""spark-submit entry point: ``spark-submit --py-files faultline.zip submit.py train ...``."""

from faultline.__main__ import main

if __name__ == "__main__":
    raise SystemExit(main())
