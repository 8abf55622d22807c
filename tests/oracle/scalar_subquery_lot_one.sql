SELECT s.codendereco, s.codprod, s.dtval,
       CAST((SELECT COALESCE(SUM(x.qt), 0) FROM pcestenderecoi x
             WHERE x.codprod = s.codprod AND x.codendereco = s.codendereco AND x.numlote = '1'
               AND x.dtval = s.dtval) AS DOUBLE) AS qt_lote1
FROM pcestendereco s
