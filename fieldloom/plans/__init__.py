"""The jobs: survey answers, people, notes, person matching and workflow audit."""
