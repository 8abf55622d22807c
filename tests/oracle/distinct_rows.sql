SELECT codprod, numlote FROM pcestenderecoi GROUP BY codprod, numlote
