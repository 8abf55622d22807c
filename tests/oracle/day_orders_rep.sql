SELECT c.codfilial AS filial, c.codusur AS cod_rca, u.nome AS nm_rca, s.codsupervisor, s.nome AS supervisor,
       c.codcli AS cod_cliente, cli.cliente AS nm_cliente, i.codprod AS cod_produto, pr.descricao AS nm_produto,
       CAST(i.qt AS DOUBLE) AS qt_vendida, CAST(i.pvenda AS DOUBLE) AS vl_venda, i.posicao AS posicao_pedido,
       pm.descricaoresumida
FROM pcpedc c
JOIN pcpedi i ON i.numped = c.numped
LEFT JOIN pcpromocaomed pm ON pm.codpromocaomed = i.codpromocaomed
LEFT JOIN pcusuari u ON u.codusur = c.codusur
LEFT JOIN pcsuperv s ON s.codsupervisor = u.codsupervisor
JOIN pcclient cli ON cli.codcli = c.codcli
JOIN pcprodut pr ON pr.codprod = i.codprod
WHERE c.data = DATE '2000-12-09' AND c.condvenda IN (1, 5)
