"""``python -m sigflow ...`` runs the command-line stages."""

from sigflow.cli import main

main(stop=True)
