from titlecorpus.cli import main

main()
