"""Entry point for spark-submit."""

from skyledger.__main__ import main

main()
