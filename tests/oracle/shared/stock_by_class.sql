SELECT f.classificacao, e.codfilial, e.qtestger
FROM pcprodut p LEFT JOIN pcfornec f ON p.codfornec = f.codfornec LEFT JOIN pcest e ON e.codprod = p.codprod
