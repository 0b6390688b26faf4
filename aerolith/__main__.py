from aerolith.cli import main

main()
